"""Column-to-column helpers: cell cleaning and report formatting."""
