"""Column expressions: casts, coercions, targets, errors, noise."""
