"""Column expressions: calendar, scores, text parsing."""
