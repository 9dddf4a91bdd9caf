"""Importing this module registers every query of the subpackage."""

from __future__ import annotations

from eventide.llm import q_ann, q_codes, q_decontam, q_documents, q_langid, q_licenses, q_lines, q_mixing, q_toxicity, q_url, q_warc, q_whiten  # noqa: F401
from eventide.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
