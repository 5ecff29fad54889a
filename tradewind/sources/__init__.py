"""Readers, writers and the role mapping of the sample tables."""
