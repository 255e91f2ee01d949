"""Readers of landed files, rule sources, and the sinks."""
