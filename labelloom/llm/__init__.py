"""Operators for training-data corpora: quality, near duplicates, tokens, pages, archives, leaks."""
