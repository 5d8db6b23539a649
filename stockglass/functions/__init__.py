"""Column functions, all of them compositions of built-in Spark expressions."""
