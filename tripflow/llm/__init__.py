"""Training-data operators: packing, deduplication, search, mixing, scans, scoring, sharding.

Nothing else in the library imports this subpackage.
"""
