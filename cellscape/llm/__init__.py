"""Operators for preparing training corpora: filters, deduplication, classifiers, encoding.

Each module holds one operator with its own interface; ``queries.py`` registers the thin
queries over the given tables.  Nothing else in the library imports this subpackage.
"""
