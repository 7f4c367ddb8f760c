"""Operators for training-data pipelines: deduplication, scans, scoring, mixing, output.

Nothing outside this package imports it.
"""
