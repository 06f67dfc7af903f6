"""Column expressions and UDF surfaces."""
