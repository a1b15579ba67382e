"""Environmental-sensor analytics on Spark: batch tables and reading streams."""
