"""Operators that prepare text for training: filters, deduplication, mixing, tokens and shards.

Nothing else in the library imports this package.
"""
