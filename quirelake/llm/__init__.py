"""Operators for preparing training text: dedup, packing, quality, formatting, tokens, archives."""
