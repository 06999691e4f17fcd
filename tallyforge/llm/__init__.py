"""Operators for training data: mapping, deduplication, tokenizing, mixing.

Nothing else in the library imports this package.
"""
