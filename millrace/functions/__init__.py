"""Column functions: all JVM-side expressions, usable in any DataFrame plan."""
