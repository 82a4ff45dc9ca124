"""Operators for large text corpora: filtering, near-duplicates, packing, sharding and mixing.

Nothing else in the library imports this subpackage.
"""
