"""DataFrame operators: latest version per key, sums of components, quality checks."""
