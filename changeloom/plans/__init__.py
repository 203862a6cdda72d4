"""Pipelines and views composed from DataFrame operations."""
