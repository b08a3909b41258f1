"""Operators for training corpora: one module per operator, queries in ``queries.py``."""
