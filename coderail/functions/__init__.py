"""Column -> Column building blocks. All are built-in Spark expressions (codegen, no Python workers)."""
