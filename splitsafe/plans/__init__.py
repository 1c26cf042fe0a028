"""Query plans: the registered queries and their DuckDB oracles."""
