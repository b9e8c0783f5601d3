"""Column expressions: rounding, statistics, text, dates."""
