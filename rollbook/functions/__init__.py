"""Column-to-column functions; all of them stay inside the JVM."""
