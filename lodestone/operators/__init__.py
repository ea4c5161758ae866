"""DataFrame operators: aggregates, ordered scans, joins, matrices, models, metrics."""
