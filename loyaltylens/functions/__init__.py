"""Column expressions: no DataFrame, no action, all evaluated inside the JVM."""
