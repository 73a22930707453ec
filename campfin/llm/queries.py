"""The registered text queries and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from campfin.llm import (q_collocations, q_conversations, q_decontaminate, q_packing, q_pii, q_quality, q_rules, q_secrets,
                         q_similar, q_substrings, q_tokens, q_toxicity, q_urls)

_MODULES = (q_collocations, q_conversations, q_decontaminate, q_packing, q_pii, q_quality, q_rules, q_secrets, q_similar,
            q_substrings, q_tokens, q_toxicity, q_urls)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
for _m in _MODULES:
    QUERIES.update(_m.QUERIES)
    ORACLE.update(getattr(_m, "ORACLE", {}))
