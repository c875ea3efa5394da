"""Column expressions and ordering helpers shared by the operators."""
