"""DataFrame to DataFrame transforms."""
