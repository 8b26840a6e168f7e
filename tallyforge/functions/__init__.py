"""Column expressions. They only build expressions, so no session is needed to import them."""
