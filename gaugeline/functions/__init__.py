"""Column expressions: names, event times, vectors."""
