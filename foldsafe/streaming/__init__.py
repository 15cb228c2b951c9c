"""Structured Streaming monitors (O1-O3)."""
