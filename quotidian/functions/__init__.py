"""Column expressions and window columns."""
