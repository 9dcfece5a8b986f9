"""Operators for training-data pipelines: deduplication, mixing, token files, language and licence scans."""
