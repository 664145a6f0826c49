"""Plans: the query catalogue (Spark queries + DuckDB oracle SQL) and the
end-to-end pipeline."""
