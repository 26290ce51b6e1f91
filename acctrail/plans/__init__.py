"""Composed queries (the pipeline stages) and the query registry."""
