"""Column functions: geography, tags and names."""
