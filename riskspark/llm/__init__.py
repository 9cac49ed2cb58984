"""Operators for large text corpora: deduplication, language and quality
labels, token accounting, packing, mixing, archives and search.

Nothing else in the library imports this subpackage.
"""
