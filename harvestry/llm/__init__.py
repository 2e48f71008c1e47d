"""Operators of a training-data pipeline: packing, filtering, extraction, matching and cleaning of large text tables."""
