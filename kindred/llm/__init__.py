"""Operators of a training-data pipeline: cleaning, duplicates, tokens, packing.

Nothing else in the library imports this subpackage.
"""
