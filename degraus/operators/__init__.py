"""DataFrame operators: row selection, reshaping, joins, set differences, aggregates, rankings."""
