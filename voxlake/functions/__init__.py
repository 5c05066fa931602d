"""Column builders: every one stays inside the JVM expression engine."""
