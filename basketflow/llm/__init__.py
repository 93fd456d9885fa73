"""Operators for training-data pipelines: tokens, quality, privacy, duplicates, archives."""
