"""Streaming of the plumbline engine."""
