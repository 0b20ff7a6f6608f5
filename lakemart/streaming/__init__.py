"""Incremental zones: landing to bronze, bronze to silver."""
