"""Property features and price models as PySpark DataFrame operations."""
