"""Column expressions shared by the metrics; all of them are built-in Spark functions."""
