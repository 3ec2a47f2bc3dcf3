"""Operators of a large-scale training-data pipeline, each with its registered query.

Nothing else in the library imports this subpackage.
"""
