"""Query of operator 10.  Edit distance to any substring has no SQL; the tests
compute it by plain dynamic programming for every (document, item) pair."""

from __future__ import annotations

from campfin.llm.common import table
from campfin.llm.decontaminate import contaminated


def op10_decontamination(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op10_decontamination": op10_decontamination}
