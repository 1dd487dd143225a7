"""Column helpers built from native Spark functions."""
