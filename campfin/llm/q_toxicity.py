"""Query of operator 3.  A trained model has no SQL; the tests measure it on
the held-out quarter and compute scores again by hand."""

from __future__ import annotations

from campfin.llm.common import table
from campfin.llm.toxicity import classify


def op3_toxicity(spark, sf_dir):
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op3_toxicity": op3_toxicity}
