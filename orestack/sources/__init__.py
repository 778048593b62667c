"""Readers, sinks and the shared working folder."""
