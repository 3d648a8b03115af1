"""Column expressions: every function takes and returns built-in Spark columns."""
