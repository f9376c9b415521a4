"""Column expressions: rounding, exact averages and text-to-type casts."""
