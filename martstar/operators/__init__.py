"""DataFrame operators of the warehouse (queries, ETL steps, checks)."""
