"""Operators for training-data pipelines: filtering, deduplication, mixing, tokenisation, search.

Nothing else in the library imports this subpackage; it uses the library's
session helpers only.
"""
