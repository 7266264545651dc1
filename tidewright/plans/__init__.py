"""Phases, their configuration, and the engine that runs them wave by wave."""
