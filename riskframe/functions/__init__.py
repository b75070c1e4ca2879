"""Column expressions: text, numbers, clock, calendar, flags, classification."""
