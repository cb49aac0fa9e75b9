"""League analytics on Spark: raw box scores to a star schema, season queries, live scores."""
