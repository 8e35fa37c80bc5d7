"""Training-data operators: deduplication, filtering, tokenizing, mixing, formatting, sharding.

Nothing else in the library imports this package.
"""
