"""Operators for training-data corpora; each module documents its method and its edge cases."""
