"""Column expressions (JVM-side, codegen'd) used by the operators."""
