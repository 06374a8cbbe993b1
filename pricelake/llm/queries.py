"""Importing this module registers the queries of all operators here."""

from __future__ import annotations

from pricelake.llm import (  # noqa: F401
    chat_format, decontaminate, hard_negatives, jaccard_join, language_id, lm_scoring, mixing, page_text,
    quality_resampling, quality_rules, secret_scan, sharding, token_alignment,
)
