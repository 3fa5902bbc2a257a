"""Endpoint-quality pipeline as DataFrame-to-DataFrame jobs on Spark."""
