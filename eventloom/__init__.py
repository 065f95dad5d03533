"""Event-record analytics on PySpark: scans, functions, operators, plans, streams and a training-data subpackage."""
