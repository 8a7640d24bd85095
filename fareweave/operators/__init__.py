"""DataFrame → DataFrame operators: filters, joins, aggregations, windows, skyline."""
