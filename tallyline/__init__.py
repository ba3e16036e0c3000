"""Record-table and event-stream analytics written as plain PySpark."""
