"""Composed queries over the operators, and the registry used by the checks."""
