"""Readers of the order, product and customer files, and the loader that routes files to them."""
