"""DataFrame operators: ordered per-person history, first/top-k per key, joins, aggregates."""
