"""Column expressions: code tables, numeric codes, compact dates, ages."""
