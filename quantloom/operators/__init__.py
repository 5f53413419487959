"""DataFrame operators: filters, joins, reshaping, windows, ordering and set operations."""
