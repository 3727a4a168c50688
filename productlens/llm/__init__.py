"""Training-data operators: tokenisation, filtering, deduplication, scoring and search over a corpus.

Nothing else in the library imports this subpackage. ``queries.py`` registers one query per operator.
"""
