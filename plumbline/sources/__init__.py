"""Sources of the plumbline engine."""
