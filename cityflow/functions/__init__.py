"""Column builders: every function returns a Column and runs inside the JVM."""
