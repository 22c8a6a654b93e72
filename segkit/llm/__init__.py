"""Operators of a training-data pipeline: extraction, scoring, joins, mixing, sharding.

Nothing else in the package imports this subpackage; ``queries.py`` registers its queries.
"""
