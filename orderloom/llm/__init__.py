"""Operators that prepare training text: filtering, deduplication, mixing, packing.

Nothing else in the library imports this subpackage.
"""
