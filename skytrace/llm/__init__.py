"""Operators for preparing training text: quality, packing, duplicates, tokens, pages, vectors."""
