"""Query of operator 4.  SQL cannot run a byte-pair encoding; the tests hold
it against the public library, text by text and prefix by prefix."""

from __future__ import annotations

import public_tokenizers

from campfin.llm.common import table
from campfin.llm.tokens import prefix_tables


def op4_token_counts(spark, sf_dir):
    return prefix_tables(table(spark, sf_dir, "documents"),
                         public_tokenizers.path("word_bpe_49k.json"), keep_deltas=False)


QUERIES = {"op4_token_counts": op4_token_counts}
