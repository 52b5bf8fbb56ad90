"""Operators of a training-data pipeline: mixing, search, sharding, scans, filters, models, dedup, token files."""
