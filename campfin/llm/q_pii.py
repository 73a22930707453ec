"""Query of operator 2.  Keyed hashes of normal forms, drawn until distinct,
have no SQL worth reading; the tests check every property on the texts."""

from __future__ import annotations

from campfin.llm.common import table
from campfin.llm.pii import replace_pii

#: Stands for the secret that a caller of the operator passes.
KEY = "corpus surrogates"


def op2_pii_surrogates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_pii(docs, KEY)


QUERIES = {"op2_pii_surrogates": op2_pii_surrogates}
