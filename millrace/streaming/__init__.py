"""Structured Streaming jobs; every one can run until caught up and resume."""
