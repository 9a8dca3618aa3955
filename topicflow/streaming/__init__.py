"""Structured Streaming: split, minute trends, live rows, landing."""
