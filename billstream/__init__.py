"""Legislative activity analytics as plain Spark DataFrame, SQL and streaming plans."""
