"""Column expressions and grouped statistics; all of them stay in the JVM."""
