"""Structured Streaming forms of the windows, and their sinks."""
