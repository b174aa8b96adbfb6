"""Whole products composed from the operators."""
