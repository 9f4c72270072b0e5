"""Column expressions and small DataFrame idioms shared by the operators."""
