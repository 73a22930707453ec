"""Query of operator 6.  Components need a recursion whose SQL is quadratic in
groups of copies; the tests compute sets, links and components by brute force."""

from __future__ import annotations

from campfin.llm.common import table
from campfin.llm.similar import similar_classes


def op6_similar_documents(spark, sf_dir):
    return similar_classes(table(spark, sf_dir, "documents"))


QUERIES = {"op6_similar_documents": op6_similar_documents}
