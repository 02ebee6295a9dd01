"""The registered queries of this package: name -> Spark query, and its check SQL where there is one."""

from __future__ import annotations

from logvigil.llm import queries_corpus, queries_native, queries_pairs, queries_text
from logvigil.llm.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES", "queries_corpus", "queries_native", "queries_pairs", "queries_text"]
