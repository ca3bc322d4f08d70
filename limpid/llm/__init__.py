"""Operators for preparing training data: packing, scans, near duplicates, quality, tokens, extraction, sharding."""
