"""Operators for preparing training data: search, archives, filters, near-duplicates and token files.

Each module is one operator with its own interface; ``queries`` applies them to
the given tables.  Nothing outside this package imports it.
"""
