"""Operators of a large-scale training-data pipeline (problems 1 to 9).

Nothing else in the library imports this subpackage; it stands alone.
"""
