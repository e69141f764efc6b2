"""Readers, cleaning steps, writers and the bindings to the test tables."""
