"""Readers, sinks and message feeds."""
