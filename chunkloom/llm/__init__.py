"""Operators for preparing training data: search, packing, scans, formatting, deduplication, classifiers."""
