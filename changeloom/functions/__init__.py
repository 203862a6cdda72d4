"""Column expressions. Every function takes and returns Columns, so it runs inside generated JVM code."""
