"""Column expressions: coercion, hashing, fiscal years, label and table text."""
