"""Column expressions and small DataFrame transforms shared by the operators."""
