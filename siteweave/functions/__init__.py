"""Column functions: text, coordinates, similarity."""
