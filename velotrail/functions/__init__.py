"""Column expressions: text layout of a track line, labels, hashing, motion."""
