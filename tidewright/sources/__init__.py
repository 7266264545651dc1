"""Readers and sinks: sources, event logs and the point store."""
