"""Operators of a training-data pipeline: search, mixing, deduplication, quality, archives, packing.

Each module is one operator with a general DataFrame interface; ``queries`` holds the thin
registered queries and their DuckDB statements.  Nothing else in the library imports this package.
"""
