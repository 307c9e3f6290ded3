"""DataFrame operators of the three layers and the data-quality checks."""
