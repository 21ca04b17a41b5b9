"""Helpers of the library."""
