"""Whole plans over units, and the suite of queries with their SQL."""
