"""Operators of a training-data pipeline: search, scoring, dedup, filtering, mixing, packing."""
