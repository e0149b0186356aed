"""Column helpers built from JVM-side functions only."""
