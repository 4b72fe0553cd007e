"""Operators for preparing training data: scans, packing, deduplication, filters, token files."""
