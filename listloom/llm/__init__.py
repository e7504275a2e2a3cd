"""Operators for preparing training data: mixing, deduplication, scans, scoring, extraction and token output."""
