"""Query of operator 9.  SQL gives matches but not their places; the tests
hold the automaton against regular expressions over whole texts."""

from __future__ import annotations

from campfin.llm.common import table
from campfin.llm.secret_scan import digest, find_secrets


def op9_secret_scan(spark, sf_dir):
    return digest(find_secrets(table(spark, sf_dir, "documents")))


QUERIES = {"op9_secret_scan": op9_secret_scan}
