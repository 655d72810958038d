"""Column-to-Column rules."""
