"""Operators of a training-data pipeline: each takes frames and gives frames.

Nothing else in the library imports this package.
"""
