"""Column expressions: exact money, ratios, calendar."""
