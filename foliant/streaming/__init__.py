"""Incremental runs of the repair and audit plan."""
