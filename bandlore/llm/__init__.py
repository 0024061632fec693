"""Operators for large text corpora: near-duplicates, language, toxicity, shards, leaks, tokens, quality, personal data."""
