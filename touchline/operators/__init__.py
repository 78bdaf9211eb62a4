"""Reusable DataFrame operators: deduplication, reshaping, fitting, rating, judging."""
