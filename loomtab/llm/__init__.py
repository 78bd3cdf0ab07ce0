"""Operators of a training-data pipeline: tokens, duplicates, pages, packing, quality, sketches."""
