"""Column functions: temporal text, JSON text, string hashing."""
