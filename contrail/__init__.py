"""Flight-operations analytics on Spark: raw feeds to typed tables, aggregates and features."""
