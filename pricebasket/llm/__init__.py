"""Operators for preparing text corpora: scoring, filtering, deduplication, packing and sharding."""
