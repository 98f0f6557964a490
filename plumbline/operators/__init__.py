"""Operators of the plumbline engine."""
