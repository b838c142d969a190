"""Column expressions: text, labels, bins, statistics, vectors."""
