"""Column functions, fixed tables and similarity scores."""
