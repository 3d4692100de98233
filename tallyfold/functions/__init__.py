"""Column expressions. Every function takes and returns Columns, nothing leaves the JVM."""
