"""Column expressions: everything here stays inside the JVM and inside whole-stage code generation where Spark allows it."""
