"""Column expressions: variance arithmetic, labels, identifiers and formatting."""
