"""Readers for landed files and append-only sinks."""
