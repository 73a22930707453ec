"""Query of operator 8.  SQL cannot encode; the tests check ids against the
public library and put every document together again from its pieces."""

from __future__ import annotations

import public_tokenizers

from campfin.llm.common import table
from campfin.llm.packing import pack


def op8_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"),
                public_tokenizers.path("byte_bpe_50k.json"), keep_ids=False)


QUERIES = {"op8_packing": op8_packing}
