"""Roll-call voting analytics on Spark."""
