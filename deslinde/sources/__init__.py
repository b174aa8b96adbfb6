"""Readers and writers for the cadastral inputs and products."""
