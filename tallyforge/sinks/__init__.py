"""Table writes and table layout."""
