"""Composed queries of the library."""
