"""Operators for preparing training data: search, deduplication, packing, scans, formatting.

Each module holds one operator and its registered query; ``queries`` collects
the queries. Nothing else in the library imports this subpackage.
"""
