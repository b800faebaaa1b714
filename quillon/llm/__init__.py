"""Operators for training-data pipelines: scoring, language, toxicity, dedup, licences, mixing, leaks, shards, PII."""
