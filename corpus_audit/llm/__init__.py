"""Operators of a training-data pipeline; their registered queries are in ``queries``."""
