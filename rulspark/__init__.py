"""Predictive-maintenance analytics as Spark jobs."""
