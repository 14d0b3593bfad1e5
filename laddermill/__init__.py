"""Ranked-match analytics as Spark DataFrame operators."""
