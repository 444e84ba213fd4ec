"""Column expressions: cleaning rules and exact rounding."""
