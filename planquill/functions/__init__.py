"""Column functions and renderers."""
