"""Query of operator 1.  Its hash has no SQL counterpart; the tests compute
everything again in Python, over whole texts."""

from __future__ import annotations

from campfin.llm.common import table
from campfin.llm.quality import judge_quality


def op1_quality_rules(spark, sf_dir):
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op1_quality_rules": op1_quality_rules}
