"""Column expressions: text, numbers and labels."""
