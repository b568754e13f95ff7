"""Web access-log analytics as lazy PySpark DataFrame pipelines."""
