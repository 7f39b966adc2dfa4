"""Column expressions shared by the operators (built-in Catalyst functions only)."""
