"""Column expressions: text, dates, geometry, classification."""
