"""Labelling as a stream."""
