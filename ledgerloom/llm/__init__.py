"""Operators that prepare text for training: deduplication, scans, scoring, tokenization.

Nothing else in the library imports this package.
"""
