"""Filters, dedup, upserts, keys, joins, aggregates and checks."""
