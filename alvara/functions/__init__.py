"""Column expressions; all of them are built-in and stay inside generated code."""
