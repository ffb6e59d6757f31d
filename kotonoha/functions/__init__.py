"""Column-level helpers used by the operators."""
