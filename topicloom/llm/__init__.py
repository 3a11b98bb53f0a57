"""Operators for large text corpora: packing, mixing, deduplication, scans and scores."""
