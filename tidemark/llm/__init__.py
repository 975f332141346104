"""Training-data operators: deduplication, classification, search, mixing and packing.

Nothing else in the library imports this subpackage.
"""
