"""Readers and normalisers of raw observations, and the lake they land in."""
