"""Change-stream analytics on PySpark: a change log is an ordinary DataFrame."""
