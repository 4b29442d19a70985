"""Commerce analytics on Spark: ETL, star schema, aggregates, queries, quality."""
