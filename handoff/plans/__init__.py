"""Composed plans: derived views over the given tables, model training, hand-over gates."""
