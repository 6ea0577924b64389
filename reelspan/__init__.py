"""Media timeline analytics on PySpark."""
