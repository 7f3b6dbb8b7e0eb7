"""Relational operators: filters, lookups, the claim match, merges, series."""
