"""Readers and writers, and the stand-in inputs derived from the test tables."""
