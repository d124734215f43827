"""Operators of a training-data pipeline: mixing, deduplication, packing, extraction, classifiers."""
