"""Operators of a training-data pipeline: filtering, dedup, scoring, packing and token files.

Nothing outside this package imports it.
"""
