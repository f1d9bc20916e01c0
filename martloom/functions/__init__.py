"""Column expressions: text cleaning, product codes, hash keys."""
