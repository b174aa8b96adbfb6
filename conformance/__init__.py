"""Checks of the library against independent SQL over the given tables."""
