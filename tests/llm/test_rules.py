import math
import random
import zlib

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from campfin.llm.common import py_words
from campfin.llm.rules import (STATISTICS, classify_quality, described, extract, fit, held_out, holds, score,
                               statistics, train)


def brute(text):
    t = text or ""
    w = py_words(t)
    lines = [x for x in t.split("\n") if py_words(x)]
    three = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]

    def share(a, b):
        return a / b if b else 0.0

    def seen(p):
        return len(regex.findall(p, t))

    end = r"(?:[\x20\x09-\x0D]|\Z)"
    return [len(w), share(sum(map(len, w)), len(w)), max(map(len, w), default=0), share(len(set(w)), len(w)),
            share(len(set(three)), len(three)) if len(w) > 2 else 1.0,
            share(sum(a == b for a, b in zip(w, w[1:])), len(w)),
            share(seen(r"[#*$%&|<>!]" + end), len(w)), share(seen(r"[#*$%&|<>]"), len(t)),
            share(seen(r"\p{Lu}"), len(t)), share(seen("[0-9]"), len(t)), share(seen("!"), len(t)),
            share(seen(r"[.?]" + end), len(w)), share(len(lines), len(w)),
            share(len(lines) - len(set(lines)), len(lines)),
            share(seen(r"[^\p{L}\p{M}\p{Nd}\p{P}\p{Sc}\t\n\x0b\f\r $+<=>^`|~]"), len(t))]


TEXTS = [None, "", " ", "a", "A a a B!! c$ d.\nA a a\n\nA a a\n", "É ß 1234 ☃ x|y\tz.\x0bq?", "ab " * 50000,
         "Wort, Wort. " * 9 + "1.5 €"]


def test_statistics_equal_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    for r in statistics(df, [F.col("i")]).collect():
        assert [r[s] for s in STATISTICS] == pytest.approx(brute(TEXTS[r["_c0"]])), TEXTS[r["_c0"]]


def corpus(n=400, seed=1):
    rnd = random.Random(seed)
    w = ["".join(rnd.choice("aeilnorst") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = [rnd.choice(w) for _ in range(rnd.randint(20, 200))]
        kind = i % 8
        if kind == 0:
            words = [x + rnd.choice(["$$$", "###"]) for x in words]
        elif kind == 1:
            words = [rnd.choice(words)] * len(words)
        docs.append((i, " ".join(words), 0.5))
        labels.append((i, int(kind > 1), 0))
    return docs, labels


LABELS = "doc_id long, quality int, toxic int"


def test_held_out_fifth_and_score_by_hand(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string, score double")
    lab = spark.createDataFrame(labels, LABELS)
    rows = classify_quality(d, lab).collect()
    truth = {i: q for i, q, _ in labels}
    assert len(rows) == len(docs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    test = [r for r in rows if r["held_out"]]
    assert len(test) > 50 and all(r["predicted"] == truth[r["doc_id"]] for r in test)
    rules, b = train(d, lab)
    by = {r["doc_id"]: r["score"] for r in rows}
    for i, t, _ in docs[:60]:
        x = brute(t)
        z = b + sum(w for rule, w in rules if all(lo < x[s] <= hi for s, lo, hi in rule))
        assert by[i] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)
    assert len(described((rules, b))) == len(rules) > 0


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = corpus(200)
    d = spark.createDataFrame(docs, "doc_id long, text string, x double")
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    a, b = (train(d, spark.createDataFrame(x, LABELS)) for x in (labels, flipped))
    assert a == b


def test_result_can_be_filtered(spark):
    docs, labels = corpus(80)
    out = classify_quality(spark.createDataFrame(docs, "doc_id long, text string, x double"),
                           spark.createDataFrame(labels, LABELS))
    n = out.where("predicted = 0 and score < 0.2").count()
    assert n == sum(r["predicted"] == 0 and r["score"] < 0.2 for r in out.collect()) > 0


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (2, ""), (None, "a b c"), (3, "ab " * 100_000), (4, "x y z."), (5, "p q r.")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "*", "'q' as _text", "1 as n_words", "0 as _good", "9 as _at")
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in classify_quality(d, none).collect()} == {0.5}
    one = spark.createDataFrame([(4, 1, 1), (5, 1, None), (5, None, 0), (None, 1, 1)], LABELS)
    assert len(classify_quality(d, one).collect()) == 7
    both = spark.createDataFrame([(4, 1, 1), (4, 0, 1), (5, 1, 0)], LABELS)
    assert len(classify_quality(d, both).collect()) == 7
    assert classify_quality(d.limit(0), one).count() == 0
    assert score(d, ([], 0.0)).count() == 7
    assert not d.select(held_out(F.lit(None).cast("long")).alias("h")).first()["h"]


def test_paths_are_conjunctions_and_lasso_is_sparse():
    rnd = np.random.default_rng(0)
    x = rnd.random((600, 4))
    good = ((x[:, 0] > 0.5) & (x[:, 2] <= 0.7)).astype(float)
    rules = extract(x, good, np.full(600, 1 / 600))
    assert all(len({s for s, *_ in r}) == len(r) <= 3 for r in rules)
    model, b = fit(x, good == 1)
    assert 0 < len(model) < len(rules) / 2
    z = b + sum(w * holds(r, x) for r, w in model)
    assert ((z > 0) == (good == 1)).mean() > 0.97
    assert all({0, 2} & {s for s, *_ in r} for r, w in model if abs(w) > 0.5)


def test_fit_agrees_with_the_optimality_conditions():
    from campfin.llm.rules import lasso
    rnd = np.random.default_rng(3)
    z = (rnd.random((300, 12)) < 0.4).astype(float)
    good = (z[:, 0] + rnd.random(300) > 1).astype(float)
    w = np.full(300, 1 / 300)
    coef, b = lasso(z, good, w, l1=0.01, rounds=4000)
    grad = z.T @ (w * (1 / (1 + np.exp(-(z @ coef + b))) - good))
    on = coef != 0
    assert np.allclose(grad[on], -0.01 * np.sign(coef[on]), atol=1e-4) and (abs(grad[~on]) <= 0.01 + 1e-4).all()


def test_documents_held_out(spark):
    d = "/root/testdata/sf0.1"
    docs, lab = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r["doc_id"]: r["quality"] for r in lab.collect()}
    rows = [r for r in classify_quality(docs, lab).collect() if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in rows]) > 0.98
