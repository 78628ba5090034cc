"""Structured Streaming form of the slot features."""
