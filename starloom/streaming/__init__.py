"""Continuous operation with Structured Streaming."""
