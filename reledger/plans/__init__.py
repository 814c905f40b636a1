"""Multi-step flows over the lake, and the registered queries."""
