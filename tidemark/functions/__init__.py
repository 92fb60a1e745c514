"""Column expressions: key hashing, coercion, local time, labels."""
