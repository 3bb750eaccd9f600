"""Column functions: every one is a composition of built-in Spark expressions."""
