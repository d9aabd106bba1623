"""Download logs to an analytics table, on Spark."""
