"""Column functions: analysis, paths, text and distances."""
