"""All registered queries (see ``registry``)."""

from campfin.plans import (  # noqa: F401  (registration side effects)
    queries_dims, queries_facts, queries_increment, queries_load, queries_runs, queries_sources,
)
from campfin.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
