"""Column expressions: text, geometry, object keys. All JVM-side."""
