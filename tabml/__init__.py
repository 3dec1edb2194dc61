"""Tabular profiling, feature preparation and model building as Spark jobs."""
