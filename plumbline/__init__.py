"""Plumbline: the life of a tabular regression model as Spark jobs."""
