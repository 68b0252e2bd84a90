"""Operators that prepare training data: dedup, decontamination, tokens, languages, shards."""
