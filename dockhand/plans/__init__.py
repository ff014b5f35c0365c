"""Plans: SQL scripts, user-code hooks, whole-flow compositions and the
registered query catalog (with DuckDB oracle SQL)."""
