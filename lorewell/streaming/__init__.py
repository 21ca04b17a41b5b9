"""Streams of records."""
