"""Structured Streaming versions of the traffic operators."""
