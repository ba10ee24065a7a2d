"""Operators for large text corpora: filtering, deduplication, personal data,
search, mixing, packing and chat formatting.

Nothing else in the library imports this subpackage.
"""
