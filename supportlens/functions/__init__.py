"""Column functions: every one returns a JVM-side expression, none is a Python UDF."""
