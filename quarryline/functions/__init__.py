"""Column expressions and Arrow column functions."""
