"""Column builders: every function here returns Spark expressions and runs no job."""
