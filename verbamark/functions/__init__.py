"""Column expressions and batch helpers."""
