"""Plans of the plumbline engine."""
