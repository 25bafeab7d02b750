"""Table operators: ranks, joins, set operations, aggregates, lookup and text jobs."""
