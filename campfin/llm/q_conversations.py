"""Query of operator 13.  SQL has no dynamic programming over a graph with
ordered ties; the tests hold it against a search over all edits."""

from __future__ import annotations

from campfin.llm.common import table
from campfin.llm.conversations import damage, judge_conversations


def op13_conversation_repair(spark, sf_dir):
    return judge_conversations(damage(table(spark, sf_dir, "conversations")), count_col="copies")


QUERIES = {"op13_conversation_repair": op13_conversation_repair}
