"""Query of operator 12.  A trained model has no SQL; the tests measure it on
the held-out fifth and compute statistics and scores again by hand."""

from __future__ import annotations

from campfin.llm.common import table
from campfin.llm.rules import classify_quality


def op12_rule_quality(spark, sf_dir):
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op12_rule_quality": op12_rule_quality}
