"""Birth-registry analytics on Spark: cleaning, star schema and reports."""
