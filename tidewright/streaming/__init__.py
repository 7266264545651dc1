"""Streams of heartbeats and status events."""
