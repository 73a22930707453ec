"""Quality classifier: a sparse ensemble of rules (operator 12).

Every text becomes a few statistics, all of them column expressions.  Small
trees are grown by boosting on labelled rows; every path from a root is a
*rule*, a conjunction of bounds on statistics.  A lasso logistic regression
over the rules leaves few of them with a weight, and those become one column
expression again: scoring is one narrow scan without Python.

The fit reads a bounded sample of labelled rows (``MOST`` of each class: the
smallest hashes of the id), as one task over at most ``2 * MOST`` rows of
``len(STATISTICS)`` numbers.  Classes weigh the same in it, so that a score of
one half means undecided however rare low quality is.
"""

from __future__ import annotations

import json
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from campfin.llm.common import words

#: Labelled rows of either class that the fit reads at most.
MOST = 4000
#: Boosted trees, their depth, shrinkage, share of rows each sees, and the
#: least rows on either side of a split.
TREES, DEPTH, SHRINK, SHARE, LEAST_ROWS = 60, 3, 0.2, 0.5, 5
#: Candidate bounds of a statistic: that many quantiles.
QUANTILES = 48
#: Lasso strength and rounds of the proximal gradient.
L1, ROUNDS = 2e-3, 600
THRESHOLD = 0.3
SEED = 7

STATISTICS = (
    "n_words", "word_length", "longest_word", "distinct_words", "distinct_trigrams", "adjacent_repeats",
    "marked_words", "symbols", "capitals", "digits", "shouts", "sentence_ends", "lines_per_word",
    "repeated_lines", "odd_characters")


def statistics(docs: DataFrame, carry: list[Column], text_col: str = "text") -> DataFrame:
    """``carry`` and the statistics (doubles) of every row; shares of nothing
    are 0, and null texts count as empty."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    names = [f"_c{i}" for i in range(len(carry))]
    d = docs.select(*[c.alias(n) for c, n in zip(carry, names)], t.alias("_t")).withColumn("_w", words(F.col("_t")))
    t, w, n = F.col("_t"), F.col("_w"), F.size("_w")

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(0.0)

    def seen(pattern: str) -> Column:
        return share(F.regexp_count(t, F.lit(pattern)), F.length(t))

    d = d.withColumns({
        "_three": F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3),
                                             lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))),
        "_lines": F.filter(F.split(t, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))),
        "_letters": F.length(F.array_join(w, "")),
        "_long": F.aggregate(w, F.lit(0), lambda a, x: F.greatest(a, F.length(x)))})
    three, lines = F.col("_three"), F.col("_lines")
    found = {
        "n_words": n,
        "word_length": share(F.col("_letters"), n),
        "longest_word": F.col("_long"),
        "distinct_words": share(F.size(F.array_distinct(w)), n),
        "distinct_trigrams": F.when(n >= 3, share(F.size(F.array_distinct(three)), F.size(three))).otherwise(1.0),
        "adjacent_repeats": share(F.size(F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, i - 1)))), n),
        "marked_words": share(F.regexp_count(t, F.lit(r"[#*$%&|<>!](?:[\x20\x09-\x0D]|$)")), n),
        "symbols": seen(r"[#*$%&|<>]"),
        "capitals": seen(r"\p{Lu}"),
        "digits": seen(r"[0-9]"),
        "shouts": seen(r"!"),
        "sentence_ends": share(F.regexp_count(t, F.lit(r"[.?](?:[\x20\x09-\x0D]|$)")), n),
        "lines_per_word": share(F.size(lines), n),
        "repeated_lines": share(F.size(lines) - F.size(F.array_distinct(lines)), F.size(lines)),
        "odd_characters": seen(r"[^\p{L}\p{M}\p{Nd}\p{P}\p{Sc}\s$+<=>^`|~]"),
    }
    return d.select(*names, *[found[s].cast("double").alias(s) for s in STATISTICS])


# -- the fit ------------------------------------------------------------------

#: A rule: ((statistic, over, up to), ...), each bound on another statistic.
Rule = tuple[tuple[int, float, float], ...]


def _bounds(x: np.ndarray) -> list[np.ndarray]:
    """Candidate bounds per statistic, halfway between neighbouring values."""
    out = []
    for col in x.T:
        v = np.unique(np.quantile(col, np.linspace(0, 1, QUANTILES + 2), method="nearest"))
        out.append((v[:-1] + v[1:]) / 2)
    return out


def _narrowed(rule: Rule, stat: int, over: float, up_to: float) -> Rule:
    kept = {s: (a, b) for s, a, b in rule}
    a, b = kept.get(stat, (-np.inf, np.inf))
    kept[stat] = (max(a, over), min(b, up_to))
    return tuple((s, *kept[s]) for s in sorted(kept))


def grow(x: np.ndarray, binned: np.ndarray, bounds: list[np.ndarray], aim: np.ndarray, weight: np.ndarray,
         rows: np.ndarray, depth: int, rule: Rule, found: list[tuple[Rule, float]], leaves: list) -> None:
    """One least-squares tree: every path goes to ``found`` (the root doesn't),
    the leaves with their weighted means to ``leaves``."""
    w, a = weight[rows], aim[rows]
    mean = (w @ a) / w.sum()
    best = None
    if depth:
        for s, cuts in enumerate(bounds):
            if not len(cuts):
                continue
            b = binned[rows, s]
            n = np.bincount(b, minlength=len(cuts) + 1)[:-1].cumsum()
            sw = np.bincount(b, w, minlength=len(cuts) + 1)[:-1].cumsum()
            sa = np.bincount(b, w * a, minlength=len(cuts) + 1)[:-1].cumsum()
            ok = (n >= LEAST_ROWS) & (len(rows) - n >= LEAST_ROWS)
            rest, total = w.sum() - sw, (w @ a)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(ok, sa**2 / sw + (total - sa)**2 / rest - total**2 / w.sum(), -1)
            k = int(gain.argmax())
            if gain[k] > 1e-9 and (best is None or gain[k] > best[0]):
                best = (gain[k], s, k)
    if best is None:
        leaves.append((rule, rows, mean))
        return
    _, s, k = best
    cut = float(bounds[s][k])
    low = binned[rows, s] <= k
    for part, over, up_to in ((rows[low], -np.inf, cut), (rows[~low], cut, np.inf)):
        then = _narrowed(rule, s, over, up_to)
        found.append((then, mean))
        grow(x, binned, bounds, aim, weight, part, depth - 1, then, found, leaves)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for s, over, up_to in rule:
        out &= (x[:, s] > over) & (x[:, s] <= up_to)
    return out


def extract(x: np.ndarray, good: np.ndarray, weight: np.ndarray) -> list[Rule]:
    """Paths of boosted trees, each once, those that hold for the same rows as
    an earlier one left out."""
    rnd = np.random.default_rng(SEED)
    bounds = _bounds(x)
    binned = np.stack([np.searchsorted(b, x[:, s], side="left") for s, b in enumerate(bounds)], 1)
    score, found = np.zeros(len(x)), []
    for _ in range(TREES):
        aim = good - 1 / (1 + np.exp(-score))
        rows = np.sort(rnd.permutation(len(x))[:max(1, int(SHARE * len(x)))])
        leaves: list = []
        grow(x, binned, bounds, aim, weight, rows, DEPTH, (), found, leaves)
        for rule, _, mean in leaves:
            score += SHRINK * 4 * mean * holds(rule, x)
    out, seen = [], set()
    for rule, _ in found:
        at = np.packbits(holds(rule, x)).tobytes()
        if at not in seen:
            seen.add(at)
            out.append(rule)
    return out


def lasso(z: np.ndarray, good: np.ndarray, weight: np.ndarray, l1: float = L1, rounds: int = ROUNDS
          ) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L1-penalised logistic regression on 0/1
    columns, by accelerated proximal gradient (the intercept isn't penalised)."""
    n = z.shape[1]
    a = np.hstack([z, np.ones((len(z), 1))])
    step = 4 / max(np.linalg.norm((a * np.sqrt(weight)[:, None]).T @ (a * np.sqrt(weight)[:, None]), 2), 1e-9)
    now = momentum = np.zeros(n + 1)
    t = 1.0
    for _ in range(rounds):
        err = weight * (1 / (1 + np.exp(-np.clip(a @ momentum, -50, 50))) - good)
        to = momentum - step * (a.T @ err)
        to[:n] = np.sign(to[:n]) * np.maximum(np.abs(to[:n]) - step * l1, 0)
        t, was = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        momentum, now = to + (was - 1) / t * (to - now), to
    return now[:n], float(now[n])


def fit(x: np.ndarray, good: np.ndarray) -> tuple[list[tuple[Rule, float]], float]:
    """Rules with their weights, and the intercept.  With one class or no rows
    there are no rules, and the intercept gives the smoothed class share."""
    good = good.astype(float)
    if not len(x) or good.min() == good.max():
        share = (good.sum() + 1) / (len(good) + 2)
        return [], float(np.log(share / (1 - share)))
    weight = np.where(good > 0, 0.5 / good.sum(), 0.5 / (1 - good).sum())
    rules = extract(x, good, weight)
    if not rules:
        return [], 0.0
    w, b = lasso(np.stack([holds(r, x) for r in rules], 1).astype(float), good, weight)
    return [(r, float(v)) for r, v in zip(rules, w) if abs(v) > 1e-6], b


# -- training rows, model, columns ---------------------------------------------


def held_out(c: Column) -> Column:
    """The fifth of documents whose labels are never learnt."""
    return F.coalesce(F.pmod(F.crc32(c.cast("string")), F.lit(5)) == 0, F.lit(False))


def training_ids(labels: DataFrame, id_col: str, most: int) -> DataFrame:
    """(_l, _good) of at most ``most`` labelled ids of either class; an id
    labelled both ways is of low quality."""
    known = (labels.select(F.col(id_col).alias("_l"), F.col("quality").cast("int").alias("_good"))
             .where("_l is not null and _good in (0, 1)").where(~held_out(F.col("_l")))
             .groupBy("_l").agg(F.min("_good").alias("_good")))
    return reduce(DataFrame.unionByName, [
        known.where(F.col("_good") == k).orderBy(F.xxhash64("_l"), "_l").limit(most) for k in (0, 1)])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST
          ) -> tuple[list[tuple[Rule, float]], float]:
    """The model; at most ``2 * most`` rows of statistics meet in one task."""
    ids = training_ids(labels, id_col, most)
    mine = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
            .join(F.broadcast(ids), F.col("_id") == F.col("_l"))
            .groupBy("_l", "_good").agg(F.min("_text").alias("_text")))
    rows = statistics(mine, [F.col("_l").cast("string"), F.col("_good")], "_text")

    def fit_all(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_c0", kind="stable")
        rules, b = fit(pdf[list(STATISTICS)].to_numpy(float), pdf["_c1"].to_numpy() == 1)
        return pd.DataFrame({"model": [json.dumps([rules, b])]})

    got = rows.groupBy().applyInPandas(fit_all, "model string").collect()
    if not got:
        return fit(np.zeros((0, len(STATISTICS))), np.zeros(0))
    rules, b = json.loads(got[0]["model"])
    return [(tuple((int(s), over, up_to) for s, over, up_to in r), w) for r, w in rules], b


def compiled(model: tuple[list[tuple[Rule, float]], float]) -> Column:
    """The model as one column expression over the statistics."""
    def test(rule: Rule) -> Column:
        parts = []
        for s, over, up_to in rule:
            parts += [F.col(STATISTICS[s]) > over] if over != -np.inf else []
            parts += [F.col(STATISTICS[s]) <= up_to] if up_to != np.inf else []
        return reduce(Column.__and__, parts)

    rules, b = model
    terms = [F.lit(float(b))] + [F.when(test(r), w).otherwise(0.0) for r, w in rules]
    while len(terms) > 1:  # a balanced sum keeps the expression shallow
        terms = [reduce(Column.__add__, terms[i:i + 2]) for i in range(0, len(terms), 2)]
    return 1 / (1 + F.exp(-terms[0]))


def described(model: tuple[list[tuple[Rule, float]], float]) -> list[str]:
    """The rules as text, heaviest first."""
    def bound(s, over, up_to):
        left = f"{over:.4g} < " if over != -np.inf else ""
        return left + STATISTICS[s] + (f" <= {up_to:.4g}" if up_to != np.inf else "")

    return [f"{w:+.3f}: " + " and ".join(bound(*c) for c in r)
            for r, w in sorted(model[0], key=lambda x: -abs(x[1]))]


def score(docs: DataFrame, model: tuple[list[tuple[Rule, float]], float], id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id, score, statistics) of every whole text.  The running number below
    the rules keeps filters on the result from being moved, with all of their
    expressions, below the statistics."""
    d = statistics(docs, [F.col(id_col)], text_col).withColumn("_at", F.monotonically_increasing_id())
    return d.select(F.col("_c0").alias(id_col), F.when(F.col("_at") >= 0, compiled(model)).alias("score"),
                    *STATISTICS)


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     threshold: float = THRESHOLD, most: int = MOST) -> DataFrame:
    """One row per document: id, held_out, score (0 to 1), predicted.

    Null and empty texts have no words and are scored by their statistics like
    others.  Null ids count as not held out and are never learnt.  Without
    labels, or with one class only, every text scores the smoothed class share.
    Repeated rows are scored each; an empty table gives no rows; very long
    texts are read whole; other columns (and labels) never enter a score.
    """
    model = train(docs, labels, id_col, text_col, most)
    return score(docs, model, id_col, text_col).select(
        id_col, held_out(F.col(id_col)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
