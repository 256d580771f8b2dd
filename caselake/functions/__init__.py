"""Column -> Column building blocks. Built-in expressions only, so they stay inside codegen."""
