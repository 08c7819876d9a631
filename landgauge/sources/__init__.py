"""Readers and writers, and parsers of landed payload columns."""
