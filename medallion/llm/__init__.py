"""Operators for text training data. Nothing else in the library imports them."""
