"""Operators for training data: filtering, deduplication, mixing, tokens, extraction."""
