"""Column expressions: dates, strings, arithmetic, vectors and boxes."""
