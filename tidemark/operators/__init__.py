"""Operators: enrichment, checks, merges, reports, run and stage analytics."""
