"""Column expressions: names, text, type recognition and casting."""
