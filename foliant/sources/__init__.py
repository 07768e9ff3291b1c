"""Readers and adapters that give tables of source units, evidence and decisions."""
