"""Whole queries: adapters from the given tables, the query catalog, its SQL twins."""
