"""Operators for training data: search, quality, duplicates, packing, scoring, mixing, counting."""
