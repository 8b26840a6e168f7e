"""Operators for preparing training data: scoring, deduplication, packing, formatting, archives."""
