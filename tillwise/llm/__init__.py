"""Operators for training-data pipelines: text extraction, filters, tokens, near duplicates, search, packing."""
