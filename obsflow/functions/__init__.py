"""Column functions. All of them stay inside the JVM."""
