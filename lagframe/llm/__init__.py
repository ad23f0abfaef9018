"""Training-data operators: packing, search, filters, deduplication, mixing.

Nothing outside this subpackage imports it; the batch library works
without it.
"""
