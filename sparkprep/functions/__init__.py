"""Column-level building blocks shared by the operators."""
