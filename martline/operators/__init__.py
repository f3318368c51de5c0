"""DataFrame operators: versions, joins, pre-aggregates, variability, change detection, quality checks."""
