"""Operators of a training-data pipeline: screening, deduplication, tokenising, sharding."""
