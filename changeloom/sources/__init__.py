"""Readers of change logs, tables and snapshots."""
