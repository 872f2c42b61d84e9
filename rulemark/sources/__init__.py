"""Delimited text sources and sinks."""
