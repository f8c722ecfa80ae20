"""Spark jobs for chunked volumetric measurement data."""
