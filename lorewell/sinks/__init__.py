"""Writers of results."""
