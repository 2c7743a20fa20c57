"""Survey-warehouse analytics as plain PySpark DataFrame operators."""
