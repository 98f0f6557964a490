"""Functions of the plumbline engine."""
