"""Named queries over the benchmark tables, each with its DuckDB oracle SQL.

``tessera.plans.catalog`` imports every query module and exposes the registry.
"""
