"""Operators for preparing text corpora: tokens, filters, duplicates, search and formatting."""
