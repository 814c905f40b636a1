"""Where reports come from: the networks, the landing area, the synthetic generator."""
