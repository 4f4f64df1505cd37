"""Column functions, all evaluated inside the JVM."""
