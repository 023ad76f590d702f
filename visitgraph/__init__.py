"""Work-record linkage on Spark."""
