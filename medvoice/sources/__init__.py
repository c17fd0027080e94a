"""Readers and writers for review tables, messages and landed files."""
