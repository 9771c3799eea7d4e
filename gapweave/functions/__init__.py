"""Column expressions; all stay inside the JVM."""
