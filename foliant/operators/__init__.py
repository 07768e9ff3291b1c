"""Repairs, detectors, provenance, audits, evidence, review, rendering."""
