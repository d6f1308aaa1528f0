"""Operators for large training-text pipelines; the rest of the library does not import them."""
