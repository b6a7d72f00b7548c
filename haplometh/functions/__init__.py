"""Column expressions: every function returns a Spark ``Column``."""
