"""The verdict against the labels, not only against the formula."""

import pytest

from pyspark.sql import functions as F

from campfin.llm.quality import buckets_for, judge_quality, trusted_ids


@pytest.mark.parametrize("load", [1, 64, 512])
def test_labelled_junk_goes_and_good_documents_stay(spark, load):
    """A corpus so many times as large has ``buckets_for`` it, and fills each as
    this one does so many fewer."""
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    n_grams = docs.agg(F.sum(F.length("text"))).first()[0] // 3
    buckets = buckets_for(n_grams * load) // load
    label = {r["doc_id"]: r["quality"] for r in labels.collect()}
    by = {0: [], 1: []}
    for r in judge_quality(docs, labels, buckets=buckets).collect():
        if r["doc_id"] in label and not r["base_failed"]:
            by[label[r["doc_id"]]].append(r["kept"])
    assert len(by[0]) > 20 and len(by[1]) > 300
    assert sum(by[0]) <= 0.1 * len(by[0])
    assert sum(by[1]) >= 0.99 * len(by[1])


def test_all_trusted_documents_count(spark):
    labels = spark.range(20_005).selectExpr("id AS doc_id", "1 AS quality")
    assert trusted_ids(labels).count() == 20_005
