"""Operators of a training-data pipeline over the ``documents`` and ``pages`` tables."""
