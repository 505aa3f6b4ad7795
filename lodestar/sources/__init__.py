"""Readers, writers and the stand-in inputs built from the driver tables."""
