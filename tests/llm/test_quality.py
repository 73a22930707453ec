import collections
import math
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from campfin.llm import quality
from campfin.llm.common import py_words
from campfin.llm.quality import BUCKETS, THRESHOLD, cut_between, judge_quality


def grams(w):
    def chain(*xs):
        h = 42
        for x in xs:
            h = xxhash.xxh64_intdigest(x.encode(), seed=h)
        return (h - (1 << 64) if h >> 63 else h) % BUCKETS
    return [chain(x) for x in w] + [chain(a, b) for a, b in zip(w, w[1:])]


def base(text):
    t = text or ""
    w = py_words(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if py_words(line):
            dup += line in seen
            seen.add(line)
    wins = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if wins[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit),
            len(w) < 10 or 100 * len(hit) > 20 * len(w))


def brute(docs, labels, threshold=THRESHOLD):
    good = {i for i, q in labels if q == 1 and i is not None}
    raw, tar = collections.Counter(), collections.Counter()
    for i, t in docs:
        g = grams(py_words(t))
        raw.update(g)
        if i in good:
            tar.update(g)
    n, m = sum(raw.values()) + BUCKETS, sum(tar.values()) + BUCKETS
    lr = [round(1000 * (math.log((tar[b] + 1) / m) - math.log((raw[b] + 1) / n))) if tar else 0
          for b in range(BUCKETS)]
    out = []
    for i, t in docs:
        g, b = grams(py_words(t)), base(t)
        s = sum(lr[x] for x in g)
        out.append((i, *b, s, len(g), not b[5] and s >= threshold * len(g)))
    return out


def brute_threshold(docs, labels):
    """The cut that the labels set, by trying every whole number."""
    label = {i: q for i, q in sorted(labels, key=lambda x: -x[1]) if i is not None}
    scores = [(s // n, label[i]) for i, *_, failed, s, n, _ in brute(docs, labels) if i in label and not failed]
    good, bad = ([x for x, q in scores if q == k] for k in (1, 0))
    if not good or not bad:
        return THRESHOLD
    at = {}
    for t in range(min(good + bad), max(good + bad) + 2):
        at.setdefault((sum(x < t for x in good), sum(x >= t for x in bad)), []).append(t)
    cost = {k: (10 * k[0] / len(good) + k[1] / len(bad), v[0]) for k, v in at.items()}
    best = at[min(cost, key=cost.get)]
    return (best[0] + best[-1]) // 2


def run(spark, docs, labels, threshold=THRESHOLD):
    d = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], "doc_id long, text string, kept string, n_words string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    return [tuple(r) for r in judge_quality(d, lab, threshold=threshold).collect()]


LINE = "one two three four five six seven eight nine ten eleven twelve"
DOCS = [(1, LINE), (2, None), (3, ""), (4, "\n\n \t"), (5, LINE + "\n" + LINE + "\n \n" + LINE), (6, "a b c d e a b c d e x"),
        (7, "a a a a a a"), (8, "#1 <b> %% |é你\U0001f600 &\x0b$\x0c*"), (9, "w%d " * 10), (9, "w%d " * 10), (None, LINE + " ten"),
        (10, " ".join(f"u{k}" for k in range(30000))), (11, "r s t u v " * 4000), (12, "a b c d"), (13, "q q%%% " * 30)]


def test_edge_cases_equal_brute_force(spark):
    labels = [(1, 1), (2, 1), (13, 0), (None, 1), (99, 1), (10, 1)]
    assert sorted(run(spark, DOCS, labels), key=str) == sorted(brute(DOCS, labels), key=str)


def test_no_labels_and_empty_tables(spark):
    assert sorted(run(spark, DOCS, []), key=str) == sorted(brute(DOCS, []), key=str)
    assert run(spark, [], [(1, 1)]) == []


def test_trusted_ids_beyond_the_broadcast_bound(spark, monkeypatch):
    labels = [(1, 1), (2, 1), (13, 0), (None, 1), (99, 1), (10, 1)]
    count = quality.bucket_counts
    monkeypatch.setattr(quality, "bucket_counts", lambda *a, **k: count(*a, **k, most_ids=2))
    assert sorted(run(spark, DOCS, labels), key=str) == sorted(brute(DOCS, labels), key=str)


def test_buckets_follow_the_corpus(spark, monkeypatch):
    d = spark.createDataFrame([(1, "x" * 3000)], "doc_id long, text string")
    assert quality.bucket_count(d) == BUCKETS and quality.bucket_count(d.limit(0)) == BUCKETS
    monkeypatch.setattr(quality, "LOAD", 1)
    monkeypatch.setattr(quality, "BUCKETS", 64)
    assert quality.bucket_count(d) == 1024
    monkeypatch.setattr(quality, "MOST_BUCKETS", 128)
    assert quality.bucket_count(d) == 128


@pytest.mark.parametrize("good,bad,cut", [
    ({}, {-5: 1}, THRESHOLD), ({3: 1}, {}, THRESHOLD), ({-10: 5, 0: 5}, {-500: 4}, -255), ({0: 1}, {5: 1}, 0),
    ({-10: 99, -300: 1}, {-200: 100}, -105), ({-10: 50, -300: 50}, {-200: 100}, -300)])
def test_the_cut_lies_between_the_labels(good, bad, cut):
    assert cut_between(good, bad) == cut


def test_result_can_be_filtered(spark):
    labels = [(1, 1), (20, 1), (13, 0)]
    d = spark.createDataFrame([(i, t) for i, t in [*DOCS, (20, LINE), (21, LINE)]], "doc_id long, text string")
    out = judge_quality(d, spark.createDataFrame(labels, "doc_id long, quality int"), threshold=-600)
    rows = out.collect()
    assert out.where("kept").count() == sum(r["kept"] for r in rows) > 0
    assert out.select("doc_id", "base_failed").where("not base_failed").count() == sum(not r["base_failed"] for r in rows)
    assert out.where("n_repeat_words > 3 and not kept").count() == sum(r["n_repeat_words"] > 3 and not r["kept"] for r in rows)


def test_documents_equal_brute_force(spark):
    d = "/root/testdata/sf0.01"
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality").collect()]
    got = sorted(run(spark, docs, labels))
    assert got == sorted(brute(docs, labels))
    by = {r[0]: r for r in got}
    fitted = brute_threshold(docs, labels)
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    assert sorted(tuple(r) for r in judge_quality(d, lab).collect()) == sorted(brute(docs, labels, fitted))
    clean = [by[i] for i, q in labels if q == 1 and not by[i][6]]
    junk = [by[i] for i, q in labels if q == 0 and not by[i][6]]
    assert all(r[-1] for r in clean)
    assert sum(not r[-1] for r in junk) > 0.4 * len(junk)


def test_every_label_sets_the_threshold(spark):
    """More labelled documents of a kind than the old bound of 3,000: none is left out."""
    rare = [(i, " ".join(f"z{i}q{k}" for k in range(12))) for i in range(10000, 10040)]
    docs = [(i, LINE + f" w{i % 7}") for i in range(3300)] + rare + [(20000 + i, LINE + " bad junk" * 2) for i in range(30)]
    labels = [(i, 1) for i, _ in docs if i < 20000] + [(20000 + i, 0) for i in range(30)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    scores = judge_quality(d, lab, threshold=THRESHOLD).withColumnRenamed("doc_id", "_id")
    assert scores.where("not base_failed").join(quality.labelled(lab), F.col("_id") == F.col("_l")).count() == 3370
    at = brute_threshold(docs, labels)
    assert quality.fitted_threshold(scores, quality.labelled(lab)) == at
    want = sorted(brute(docs, labels, at))
    assert sorted(tuple(r) for r in judge_quality(d, lab).collect()) == want
    for most in (quality.MOST_IDS, 5):
        assert sorted(r["doc_id"] for r in quality.keep_good(d, lab, most_ids=most).collect()) == [r[0] for r in want if r[-1]]


def test_main_path_is_native(spark):
    d = spark.createDataFrame(DOCS, "doc_id long, text string")
    lab = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    plan = judge_quality(d, lab)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Exchange" not in plan


def test_ratios_are_no_part_of_a_plan(spark):
    """The driver keeps the texts of plans: they don't hold a number per bucket, nor does any row."""
    d = spark.createDataFrame(DOCS, "doc_id long, text string")
    lab = spark.createDataFrame([(1, 1), (13, 0)], "doc_id long, quality int")
    for out in (judge_quality(d, lab, threshold=-600), quality.keep_good(d, lab), quality.keep_good(d, lab, threshold=-600)):
        plan = out._jdf.queryExecution()
        assert len(plan.toString()) < BUCKETS
        assert "Subquery" in plan.executedPlan().toString() and "_r#" not in plan.executedPlan().toString()


def test_every_ngram_is_hashed_once_and_compiled(spark):
    """Counting has no lambda (those aren't compiled) and splits a text once; no word is fetched by its place."""
    d = spark.createDataFrame(DOCS, "doc_id long, text string")
    lab = spark.createDataFrame([(1, 1), (13, 0)], "doc_id long, quality int")
    plan = quality.bucket_counts(d, quality.trusted_ids(lab))._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and plan.count("split(") == 1 and "_w#" not in plan.split("Generate inline")[0]
    plan = judge_quality(d, lab, threshold=-600)._jdf.queryExecution().executedPlan().toString()
    assert "sequence(" not in plan


WINDOWS = ["a b c d", "a b c d e", "a b c d a b c d", "a b c d x a b c d y", "a b c d e a b c d e", "a b c d e x a b c d e",
           "x a b c d e y z a b c d e q r s t u v w", "a a a a a", "a a a a a a", "a a b a a b a a b a a b", "a b a b a b a b",
           "a b c d e f a b c d e g b c d e f", "é 😀 你 é 😀 你 é 😀 你", "ab c d e f a bc d e f ab c d e f"]


@pytest.mark.parametrize("buckets", [BUCKETS, 1024, 1000])
def test_windows_and_buckets_equal_brute_force(spark, monkeypatch, buckets):
    """Four words that come twice are no window; any number of buckets."""
    monkeypatch.setitem(globals(), "BUCKETS", buckets)
    docs, labels = list(enumerate(WINDOWS)), [(1, 1), (6, 1), (2, 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = judge_quality(d, spark.createDataFrame(labels, "doc_id long, quality int"), buckets=buckets, threshold=THRESHOLD)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute(docs, labels))
