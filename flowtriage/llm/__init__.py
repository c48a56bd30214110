"""Operators for large training-data pipelines.

Each module is one operator with its own general interface; ``queries`` binds
them to the registered ``opN_*`` queries and ``sql`` holds their DuckDB text.
Nothing else in the package imports this subpackage.
"""
