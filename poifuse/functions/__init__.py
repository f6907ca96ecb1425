"""Column builders: every rule is an expression over built-in functions."""
