"""Training-data operators: filtering, deduplication, packing, mixing and media columns.

Nothing outside this subpackage imports it.
"""
