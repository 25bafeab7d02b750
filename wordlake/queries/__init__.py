"""Driver queries over the given tables, each with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from wordlake.queries import contracts, corpus, flows, jobs, shards, tables

QUERIES = corpus.QUERIES | tables.QUERIES | shards.QUERIES | jobs.QUERIES | flows.QUERIES | contracts.QUERIES
SQL = corpus.SQL | tables.SQL | shards.SQL | jobs.SQL | flows.SQL | contracts.SQL
