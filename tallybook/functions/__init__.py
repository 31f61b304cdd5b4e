"""Column functions: hashing, text, vectors, bid policies."""
