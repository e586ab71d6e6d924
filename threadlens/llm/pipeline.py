"""Registers ``corpus_pipeline.run`` as the query ``pipeline``."""

from __future__ import annotations

import corpus_pipeline
from threadlens.llm.registry import query

query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
