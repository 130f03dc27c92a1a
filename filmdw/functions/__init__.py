"""Column expressions. All are built-in functions, so plans stay in generated code."""
