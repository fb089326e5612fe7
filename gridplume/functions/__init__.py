"""Column expressions: numbers, dates and fuel labels."""
