"""E-commerce lakehouse analytics as PySpark table and stream operators."""
