"""Structured Streaming jobs: landing of messages, scoring of landed files."""
