"""Operators for training data: filters, duplicates, mixtures, tokens. Nothing outside imports this package."""
