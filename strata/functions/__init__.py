"""Column-expression building blocks shared by the operators."""
