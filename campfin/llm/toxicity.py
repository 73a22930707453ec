"""Toxicity: a linear classifier on character n-grams whose features are
scaled by naive Bayes log-count ratios (operator 3).

A text's features are the distinct n-grams of characters (code points) of its
lower-cased form, hashed into ``DIMS`` buckets.  With p and q the smoothed shares of toxic and
of other training texts that hold a feature, its value is ``r = log(p / q)``;
a regularised logistic regression is fitted on those values.  Features that
are rare (``LEAST_SHARE`` of the training texts) or tell little
(``LEAST_RATIO``) are left out, so that the many features of a long text don't
add up to a verdict.

The fit reads a bounded sample of labelled rows (``MOST_TOXIC``,
``MOST_OTHER``: the smallest hashes of doc_id in each class).  Training rows
become sparse features in tasks; the fit itself is one task over at most that
many rows.  The model has ``DIMS`` weights whatever the corpus.  Scoring is
one narrow pass over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

DIMS = 1 << 18
ORDERS = (4, 6)
MOST_TOXIC = 1500
MOST_OTHER = 2500
THRESHOLD = 0.3
LEAST_SHARE, LEAST_RATIO = 0.01, 1.0
ROUNDS, L2 = 200, 1e-3
SLICE = 1 << 20
MIX = np.uint64(0xD6E8FEB86659FD93)


def features(text: str | None) -> np.ndarray:
    """Distinct hashed n-gram buckets of a whole text, unordered."""
    c = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-32-le", "replace"), "<u4")
    seen: list[np.ndarray] = []
    for at in range(0, len(c), SLICE):
        part = c[at:at + SLICE + max(ORDERS) - 1].astype(np.uint64)
        key = np.zeros(len(part), np.uint64)
        for n in range(1, max(ORDERS) + 1):
            m = len(part) - n + 1
            if m < 1:
                break
            key = key[:m] * MIX + part[n - 1:]
            if n in ORDERS:
                seen.append((key * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(46)).astype(np.int64))
    if not seen:
        return np.empty(0, np.int64)
    return _distinct(np.concatenate(seen))


_mark = np.empty(DIMS, np.int64)


def _distinct(idx: np.ndarray) -> np.ndarray:
    """Distinct buckets without sorting: the last writer of a bucket stays."""
    order = np.arange(len(idx))
    _mark[idx] = order
    return idx[_mark[idx] == order]


def fit(rows: list[np.ndarray], toxic: np.ndarray, rounds: int = ROUNDS, l2: float = L2
        ) -> tuple[np.ndarray, float]:
    """Weights (ratio and regression multiplied) and intercept."""
    share = (toxic.sum() + 1) / (len(rows) + 2)
    weights, b = np.zeros(DIMS), float(np.log(share / (1 - share)))
    if not len(rows) or toxic.all() or not toxic.any():
        return weights, b
    p, q = np.zeros(DIMS), np.zeros(DIMS)
    for idx, t in zip(rows, toxic):
        (p if t else q)[idx] += 1
    ratio = np.log((p + 1) / (toxic.sum() + 1)) - np.log((q + 1) / ((~toxic).sum() + 1))
    use = (p + q >= max(2, len(rows) * LEAST_SHARE)) & (abs(ratio) >= LEAST_RATIO)
    rows = [idx[use[idx]] for idx in rows]
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    kept, cols = np.unique(np.concatenate(rows), return_inverse=True)
    if not len(kept):
        return weights, b
    # Adam on the mean logistic loss; ``value`` is the scaled feature.
    value, y = ratio[kept][cols], toxic.astype(float)
    par, m1, m2 = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    par[-1] = b
    for t in range(1, rounds + 1):
        z = np.bincount(doc, par[cols] * value, minlength=len(rows)) + par[-1]
        err = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / len(rows)
        grad = np.append(np.bincount(cols, err[doc] * value, minlength=len(kept))
                         + l2 * par[:-1], err.sum())
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad**2
        par -= 0.05 * np.sqrt(1 - 0.99**t) / (1 - 0.9**t) * m1 / (np.sqrt(m2) + 1e-7)
    weights[kept] = par[:-1] * ratio[kept]
    return weights, float(par[-1])


def held_out(id_col) -> Column:
    """The quarter of documents whose labels are never learnt."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str,
                    most_toxic: int, most_other: int) -> DataFrame:
    """(toxic, text) of at most so many labelled documents of either class,
    the held-out quarter left out; a document labelled both ways is toxic."""
    known = (labels.select(F.col(id_col).alias("_id"), F.col("toxic").cast("int").alias("toxic"))
             .where("_id is not null and toxic in (0, 1)").where(~held_out("_id"))
             .groupBy("_id").agg(F.max("toxic").alias("toxic")))

    def some(kind: int, most: int) -> DataFrame:
        return known.where(F.col("toxic") == kind).orderBy(F.xxhash64("_id"), "_id").limit(most)

    sample = some(1, most_toxic).unionByName(some(0, most_other)).withColumnRenamed("_id", "_l")
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return (texts.join(F.broadcast(sample), F.col("_id") == F.col("_l"))
            .groupBy("_id", "toxic").agg(F.min("text").alias("text")).select("_id", "toxic", "text"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          most_toxic: int = MOST_TOXIC, most_other: int = MOST_OTHER) -> tuple[np.ndarray, float]:
    """The model: ``DIMS`` weights and an intercept."""
    sample = training_sample(docs, labels, id_col, text_col, most_toxic, most_other)

    def to_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                idx = [features(t).astype("<i4").tobytes() for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.string()), part.column(1), pa.array(idx, pa.binary())],
                    ["id", "toxic", "idx"])

    def fit_all(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        w, b = fit([np.frombuffer(x, "<i4") for x in pdf["idx"]], pdf["toxic"].to_numpy() == 1)
        return pd.DataFrame({"weights": [w.astype("<f4").tobytes()], "intercept": [b]})

    rows = (sample.mapInArrow(to_features, "id string, toxic int, idx binary")
            .groupBy().applyInPandas(fit_all, "weights binary, intercept double").collect())
    if not rows:
        return fit([], np.zeros(0, bool))
    return np.frombuffer(bytes(rows[0]["weights"]), "<f4").astype(float), rows[0]["intercept"]


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                z = np.array([w[features(t)].sum() + b for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -50, 50))))],
                    ["_id", "score"])

    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = src.schema["_id"].dataType.simpleString()
    return src.mapInArrow(run, f"_id {kind}, score double").withColumnRenamed("_id", id_col)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, held_out, score (0 to 1), predicted.

    Null and empty texts have no features and score the class share of the
    sample.  Null ids count as not held out and are never learnt.  Without
    labels, or with one class only, every text scores that share.  Repeated
    rows are scored each; an empty table gives no rows; other columns (and
    labels) never enter a score.
    """
    model = train(docs, labels, id_col, text_col)
    return score(docs, model, id_col, text_col).select(
        id_col, held_out(id_col).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
