"""DuckDB oracle SQL, one statement per registered query.

Independent re-statements of each query in SQL over the same Parquet
tables (pre-registered as views by the checker).  Shared building blocks
are CTE fragments below; every query string is self-contained.
"""
