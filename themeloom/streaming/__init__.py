"""Structured Streaming: assignment, windows, drift."""
