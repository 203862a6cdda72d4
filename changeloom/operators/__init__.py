"""Change-log and table operators."""
