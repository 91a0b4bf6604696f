"""Operators: plain DataFrame -> DataFrame functions, usable with ``df.transform``."""
