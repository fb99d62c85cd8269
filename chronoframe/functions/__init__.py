"""Column-level functions: event time, labels, hashing (all JVM-side expressions)."""
