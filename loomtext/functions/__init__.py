"""Column functions: no user-defined code, so they stay in whole-stage codegen where Spark has it."""
