"""Training-data operators: tokenizing, deduplication, mixing, filtering, archives and search.

Nothing outside this subpackage imports it.
"""
