"""Inputs: event files, change streams, lookup files, relational tables."""
