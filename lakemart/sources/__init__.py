"""Schemas, readers, writers and day slicing for the nine source tables."""
