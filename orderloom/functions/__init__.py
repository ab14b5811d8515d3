"""Column builders: text, time and domain rules. All JVM-side expressions."""
