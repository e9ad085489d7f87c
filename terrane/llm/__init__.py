"""Operators that prepare text and vectors for training. Nothing else in the library imports them."""
