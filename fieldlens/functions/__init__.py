"""Column functions: no I/O, no shuffle, evaluated inside the JVM."""
