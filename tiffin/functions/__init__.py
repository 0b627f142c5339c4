"""Column helpers composed from built-in Spark functions."""
