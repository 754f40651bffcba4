"""Structured Streaming versions of the live review path."""
