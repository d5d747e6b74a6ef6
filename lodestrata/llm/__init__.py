"""Operators for preparing training data: tokens, mixing, scoring, search, duplicates, shards, quality, language."""
