"""Machine-translation evaluation as Spark DataFrame operations."""
