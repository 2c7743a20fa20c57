"""Column-level helpers; everything stays a JVM expression."""
