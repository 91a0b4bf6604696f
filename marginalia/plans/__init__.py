"""Whole jobs: label a file, check a labelled table, and the registered queries."""
