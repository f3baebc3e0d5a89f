"""Plans: the registered queries, their DuckDB oracles and the pipeline."""
