"""Operators of a training-data pipeline over documents, vectors and pages.

Each module holds one operator with a general interface; ``queries``
registers one query per operator over the given tables and ``sql`` holds
the DuckDB statements where SQL can express the result.  Nothing else in
the library imports this subpackage.
"""
