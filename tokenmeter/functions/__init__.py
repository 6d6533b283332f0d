"""Column expressions (JVM-side, codegen'd) shared by the operators."""
