"""Readers, rule sets and writers."""
