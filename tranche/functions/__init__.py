"""Column expressions; every function returns a Column evaluated inside the JVM."""
