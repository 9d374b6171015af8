"""Column-expression functions (JVM side, inside whole-stage codegen)."""
