"""Cross-engine checks: DuckDB oracle SQL for the registered queries."""
