"""Column expressions and small DataFrame algorithms shared by the operators."""
