"""Row-flow data quality on Spark: read, de-duplicate, derive, check, and write tables."""
