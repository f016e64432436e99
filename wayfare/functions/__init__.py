"""Column expressions: everything here takes and returns ``Column`` and runs JVM-side."""
