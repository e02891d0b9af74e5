"""Column expressions; all of them built-in, so they stay inside code generation."""
