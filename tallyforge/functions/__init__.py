"""Column expressions: parsing, row order, moments, labels."""
