"""Results do not depend on how a scan is split from one job to the next."""

import uuid

import pytest

from campfin.llm import pii, similar
from campfin.session import scratch_path

from .test_pii import check
from .test_similar import brute


@pytest.fixture
def resplit(spark, monkeypatch):
    """After every stored table the scans are split differently."""
    name = "spark.sql.files.openCostInBytes"
    old, turn = spark.conf.get(name), [0]

    def wrap(stored):
        def run(df, label):
            out = stored(df, label)
            turn[0] += 1
            spark.conf.set(name, "1" if turn[0] % 2 else str(1 << 30))
            return out
        return run

    for module in (pii, similar):
        monkeypatch.setattr(module, "stored", wrap(module.stored))
    spark.conf.set(name, str(1 << 30))
    yield
    spark.conf.set(name, old)


def table(spark, rows):
    path = scratch_path(spark, "split-" + uuid.uuid4().hex[:6])
    spark.createDataFrame(rows, "doc_id long, text string").repartition(6, "doc_id").write.parquet(path)
    return spark.read.parquet(path)


def test_one_per_class(spark, resplit):
    rows = [(i, " ".join(f"w{i % 20}x{j}" for j in range(30))) for i in range(60)]
    got = similar.one_per_class(table(spark, rows)).collect()
    assert {r["doc_id"] for r in got} == {d for d, _, c in brute(rows) if d == c}


def test_replace_pii(spark, resplit):
    rows = [(i, f"doc {i} of a{i}@b{i}.example.net" if i % 2 else f"doc {i}") for i in range(40)]
    old = dict(rows)
    got = pii.replace_pii(table(spark, rows), "k").collect()
    assert sorted(r["doc_id"] for r in got) == sorted(old)
    check([(old[r["doc_id"]], r["text"], r["n_replaced"], r["kinds"]) for r in got])
