"""Column-expression building blocks (all JVM-side built-ins)."""
