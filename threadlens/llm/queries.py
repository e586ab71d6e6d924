"""Imports every operator, which registers its query."""

from threadlens.llm import decontaminate, lm_score, mixing, near_dups, pii, quality_model, quality_rules, substring_dedup, suffix_dedup, token_counts  # noqa: F401
from threadlens.llm import prefix_trie, spotsigs, whitening  # noqa: F401
from threadlens.llm.registry import OP_ORACLES, OP_QUERIES  # noqa: F401
