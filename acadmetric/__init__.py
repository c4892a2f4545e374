"""Evaluation analytics for graduate programs, written as Spark jobs."""
