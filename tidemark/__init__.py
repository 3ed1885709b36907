"""Change-data-capture tables and streams on PySpark."""
