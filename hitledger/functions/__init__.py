"""SQL expressions of built-in functions. Nothing here runs Python per row."""
