"""DataFrame operators: index tables, joins on a term, top-N."""
