"""Column expressions: all JVM side, none of them a Python UDF."""
