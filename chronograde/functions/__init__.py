"""Column-level building blocks (all JVM-side expressions, no Python UDF)."""
