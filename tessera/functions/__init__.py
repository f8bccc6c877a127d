"""Column functions: derived amounts, display text and JSON-ready values."""
