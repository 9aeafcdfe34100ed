"""Column expressions: text, labels, times and identifiers."""
