"""Operators for large-scale training-data preparation.

Each module holds one operator with its own general interface; ``queries`` holds
the thin registered queries and their DuckDB SQL.  Nothing else in the library
imports this package.
"""
