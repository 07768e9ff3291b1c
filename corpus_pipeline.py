"""The corpus pipeline: documents through the stages of ``STAGES``, each written and read again."""

from __future__ import annotations

from foliant.llm import pipeline

STAGES = pipeline.STAGES
ORACLE_SQL = None
run = pipeline.run
