"""Document-pipeline analytics as PySpark DataFrame operations."""
