"""Column functions: pure expressions, no UDFs."""
