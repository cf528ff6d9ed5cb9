"""Column expressions; every one stays inside Spark's generated code."""
