"""Structured Streaming form of the hourly feed."""
