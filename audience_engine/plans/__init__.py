"""Whole pipelines, and the registered queries with their check SQL."""
