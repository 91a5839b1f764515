"""Column expressions and column metadata."""
