"""Quality rules (operator 1): base rules, and a log-likelihood ratio of
hashed n-grams between trusted text and the whole corpus.

Two multinomials over hashed uni- and bigrams are estimated: one from trusted
documents, one from all documents.  A document's score is the mean log ratio of
its n-grams' buckets.  The ratios are rounded to whole thousandths, so scores
are integer sums and the threshold decides the same for every order of
summation.

The number of buckets follows the corpus (``bucket_count``), so that a bucket
holds at most ``LOAD`` n-grams up to ``MOST_BUCKETS``.  The **threshold follows
the labels**: all labelled documents are scored with the job's own ratios, and
the threshold is the middle of the gap (or best cut) between scores labelled good
and bad.  So the verdict does not loosen as buckets fill.

All of it is DataFrame expressions: one scan counts the n-grams of all and of
trusted documents (partial aggregation leaves at most one row a bucket and task
to shuffle), one scan scores; its counts (no text) are written, and the threshold
and the verdicts follow from them.  Trusted ids come to the texts as a broadcast of
counted size; beyond ``MOST_IDS`` of them trusted documents are counted in a
scan of their own, by a shuffle join (with the same counts).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from campfin.llm.common import words
from campfin.llm.components import stored

#: Buckets of a corpus up to ``BUCKETS * LOAD`` n-grams; twice as many for
#: every further doubling, up to ``MOST_BUCKETS`` (a text of some 12 MB).
BUCKETS, MOST_BUCKETS, LOAD = 1 << 18, 1 << 21, 1 << 11
#: Least mean log ratio, in thousandths, where labels give no threshold.
THRESHOLD = -400
#: How many kept bad documents a lost good one weighs.
GOOD_WEIGHT = 10
#: Trusted ids that are broadcast at most (8 bytes each, about 50 MB hashed).
MOST_IDS = 1_000_000
SMOOTHING = 1.0
SYMBOLS = "[#*$%&|<>]"


def trusted_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Ids of all labelled good documents."""
    return labels.where("quality = 1").select(F.col(id_col).alias("_trusted")).dropna().distinct()


def bucket_of(h: Column, buckets: int = BUCKETS) -> Column:
    """Bucket of a 64-bit hash (of a power of two of buckets: its low bits)."""
    if buckets & (buckets - 1):
        return F.pmod(h, F.lit(buckets)).cast("int")
    return h.bitwiseAND(F.lit(buckets - 1).cast("long")).cast("int")


def neighbours(a: Column, apart: int) -> Column:
    """A 64-bit hash of every two items of an array that lie so far apart."""
    n = F.greatest(F.size(a) - apart, F.lit(0))
    return F.zip_with(F.slice(a, 1, n), F.slice(a, 1 + apart, n), lambda x, y: F.xxhash64(x, y))


def buckets_for(n_grams: int) -> int:
    """Buckets for a corpus of about so many n-grams."""
    buckets = BUCKETS
    while buckets < MOST_BUCKETS and n_grams > buckets * LOAD:
        buckets *= 2
    return buckets


def bucket_count(docs: DataFrame, text_col: str = "text") -> int:
    """Buckets for a corpus: a text of n characters has about n / 3 n-grams."""
    return buckets_for((docs.agg(F.sum(F.length(text_col))).first()[0] or 0) // 3)


def bucket_counts(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, id_col: str = "doc_id",
                  text_col: str = "text", most_ids: int = MOST_IDS) -> DataFrame:
    """(bucket, n, good): n-grams of all documents and of trusted ones."""
    def counted(d: DataFrame, flag: Column) -> DataFrame:
        w = d.select(words(F.col(text_col)).alias("_w"), flag.cast("int").alias("_flag"))
        # Words are rows here, each with its next one: hashed in a lambda, they aren't compiled.
        pairs = F.arrays_zip("_w", F.slice("_w", 2, F.size("_w")))
        one = bucket_of(F.xxhash64("_x"), buckets)
        two = F.when(F.col("_y").isNotNull(), bucket_of(F.xxhash64("_x", "_y"), buckets))
        return (w.select("_flag", F.inline(pairs).alias("_x", "_y"))
                .select("_flag", F.explode(F.array(one, two)).alias("bucket")).where("bucket is not null")
                .groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("_flag").cast("long").alias("good")))

    own = docs.select(F.col(id_col).alias("_id"), text_col)
    trusted = stored(trusted, "trusted")
    if trusted.count() <= most_ids:
        known = own.join(F.broadcast(trusted), F.col("_id") == F.col("_trusted"), "left")
        return counted(known, F.col("_trusted").isNotNull())
    good = own.join(trusted, F.col("_id") == F.col("_trusted"), "left_semi")
    return (counted(own, F.lit(False)).unionByName(counted(good, F.lit(True)).withColumn("n", F.lit(0)))
            .groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("good").alias("good")))


def log_ratios(counts: DataFrame, buckets: int = BUCKETS) -> Column:
    """A scalar subquery for the array of thousandths of log(p_trusted / p_corpus)
    per bucket (zeros where nothing is trusted).  The array is written as one row
    and never becomes part of a plan, of which the driver keeps texts: there it
    would stand once for every use, some 1.3 MB each."""
    counts = stored(counts, "counts")
    total = counts.agg(F.sum("n").alias("tn"), F.sum("good").alias("tg"))
    more = SMOOTHING * buckets
    ratio = (F.log((F.coalesce("good", F.lit(0)) + SMOOTHING) / (F.col("tg") + more))
             - F.log((F.coalesce("n", F.lit(0)) + SMOOTHING) / (F.col("tn") + more)))
    each = (counts.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(counts, "bucket", "left")
            .join(F.broadcast(total))  # one row
            .select("bucket", F.when(F.col("tg") > 0, F.round(1000 * ratio)).otherwise(0).cast("int").alias("r")))
    row = each.agg(F.transform(F.sort_array(F.collect_list(F.struct("bucket", "r"))), lambda x: x["r"]).alias("r"))
    return stored(row, "ratios").scalar()


def base_rules(d: DataFrame) -> DataFrame:
    """Words (_w), a hash of every two neighbouring ones (_b) and the base
    counters of every row (_id: any type, _t: text)."""
    t = F.col("_t")
    d = d.withColumn("_w", words(t))
    w = F.col("_w")
    lines = F.filter(F.split(t, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    d = d.select(
        "_id", "_w", neighbours(w, 1).alias("_b"), F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"), lines.alias("_lines"))
    # Two pairs make a window of four words; only texts in which one comes twice
    # need those of five, and only if one of these does sort them.
    d = d.withColumns({
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_h4": neighbours(F.col("_b"), 2)}).drop("_lines")
    d = d.withColumn("_h5", F.when(F.size(F.array_distinct("_h4")) < F.size("_h4"),
                                   neighbours(F.col("_h4"), 1))).drop("_h4")
    d = d.withColumn("_s", F.when(F.size(F.array_distinct("_h5")) < F.size("_h5"), F.sort_array(F.transform(
        "_h5", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("_h5")
    s = F.col("_s")
    at = F.sort_array(F.filter(F.transform(s, lambda x, k: F.when(
        (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"])),
        lambda x: x.isNotNull()))
    d = d.withColumn("_at", at).drop("_s")
    p = F.col("_at")
    covered = F.aggregate(
        F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1),
                   lambda a, b: F.least(b - a, F.lit(5))), F.lit(5), lambda x, y: x + y)
    return d.withColumn("n_repeat_words", F.when(F.size(p) > 0, covered).otherwise(0).cast("long")
                        ).drop("_at")


def cut_between(good: dict[int, int], bad: dict[int, int], otherwise: int = THRESHOLD) -> int:
    """The least score to keep, from counts of whole-thousandth scores: the cut
    that loses fewest good and keeps fewest bad documents (one lost good weighs
    ``GOOD_WEIGHT`` kept bad ones, by shares), in the middle of the best range."""
    if not good or not bad:
        return otherwise
    n_good, n_bad = sum(good.values()), sum(bad.values())
    points = sorted(set(good) | set(bad))
    costs, lost, kept = [], 0, n_bad
    for score in [*points, points[-1] + 1]:  # the cut keeps scores from here on
        costs.append((GOOD_WEIGHT * lost / n_good + kept / n_bad, score))
        lost, kept = lost + good.get(score, 0), kept - bad.get(score, 0)
    best = min(costs)[0]
    i = next(i for i, (c, _) in enumerate(costs) if c == best)
    below = points[i - 1] if i else points[0]
    return (below + costs[i][1] + 1) // 2 if i else points[0]


def _scored(d: DataFrame, ratios: Column, buckets: int) -> DataFrame:
    """The columns of ``d`` with n_grams and ratio_sum in place of the words and pairs.
    A subquery can't stand in a lambda, so it is a column first; as every
    column it stands beside is plain or used once, the optimizer puts it in its
    place and no row carries the array."""
    n = F.col("n_words")
    hashes = F.concat(F.transform("_w", lambda x: F.xxhash64(x)), "_b")
    return d.withColumn("_r", ratios).withColumns({
        "n_grams": F.when(n > 1, 2 * n - 1).otherwise(n),
        "ratio_sum": F.aggregate(hashes, F.lit(0).cast("long"),
                                 lambda a, h: a + F.get("_r", bucket_of(h, buckets)))}).drop("_r", "_w", "_b")


def labelled(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(_l, _good) of every labelled id; an id labelled both ways counts as bad."""
    return (labels.select(F.col(id_col).alias("_l"), F.col("quality").cast("int").alias("_good"))
            .where("_l is not null and _good in (0, 1)").groupBy("_l").agg(F.min("_good").alias("_good")))


def fitted_threshold(scores: DataFrame, known: DataFrame) -> int:
    """The threshold from the ``scores`` (_id, base_failed, ratio_sum, n_grams)
    of all ``known`` documents that pass the base rules; only the counts of each
    whole-thousandth score reach the driver."""
    d = scores.where("not base_failed").join(known, F.col("_id") == F.col("_l"))
    rows = (d.select("_good", F.floor(F.col("ratio_sum") / F.col("n_grams")).alias("score"))
            .groupBy("_good", "score").count().collect())
    by = {k: {int(r["score"]): r["count"] for r in rows if r["_good"] == k} for k in (0, 1)}
    return cut_between(by[1], by[0])


def _base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _ratios(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, buckets: int | None
            ) -> tuple[Column, int]:
    buckets = buckets or bucket_count(docs, text_col)
    return log_ratios(bucket_counts(docs, trusted_ids(labels, id_col), buckets, id_col, text_col), buckets), buckets


def _judged(docs: DataFrame, carry: Column, text_col: str, ratios: Column, buckets: int) -> DataFrame:
    """(_id: ``carry``, _q: everything about the row but the verdict)."""
    return _guarded(docs.select(carry.alias("_id"), F.coalesce(docs[text_col], F.lit("")).alias("_t")),
                    ratios, buckets)


def _kept(q: str, threshold: int) -> Column:
    return ~F.col(f"{q}base_failed") & (F.col(f"{q}ratio_sum") >= threshold * F.col(f"{q}n_grams"))


def _guarded(d: DataFrame, ratios: Column, buckets: int) -> DataFrame:
    """(_id, _q) of (_id, _t).  A filter moved below these projections would
    repeat their expressions many times over; it stays above a struct that
    isn't deterministic."""
    d = _scored(base_rules(d).withColumn("base_failed", _base_failed()), ratios, buckets)
    return d.select("_id", F.struct(*_BASE, "base_failed", "ratio_sum", "n_grams",
                                    F.monotonically_increasing_id().alias("at")).alias("_q"))


def judge_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  buckets: int | None = None, threshold: int | None = None) -> DataFrame:
    """One row per document: id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, ratio_sum (thousandths), n_grams, kept.

    ``kept`` is false where a base rule fails, else whether
    ``ratio_sum >= threshold * n_grams``; ``buckets`` and ``threshold`` follow
    the corpus and the labels unless given.  Null and empty texts have no words
    and fail the base rules; null ids are judged like others (but never
    trusted); without trusted documents every ratio is 0, and without labels of
    both kinds the threshold is ``THRESHOLD``.  Repeated rows are judged alike
    and kept as rows; very long texts stay whole in their row; an empty table
    gives none; other columns are not read.  Repeated windows are told by 64-bit
    hashes within a text.
    """
    ratios, buckets = _ratios(docs, labels, id_col, text_col, buckets)
    d = _judged(docs, docs[id_col], text_col, ratios, buckets).select(
        "_id", *[F.col(f"_q.{c}").alias(c) for c in (*_BASE, "base_failed", "ratio_sum", "n_grams")])
    if threshold is None:  # texts are judged once; the threshold follows from what was written
        d = stored(d, "judged")
        threshold = fitted_threshold(d, labelled(labels, id_col))
    return d.select(F.col("_id").alias(id_col), *_BASE, "base_failed", "ratio_sum", "n_grams",
                    _kept("", threshold).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              buckets: int | None = None, threshold: int | None = None, most_ids: int = MOST_IDS) -> DataFrame:
    """The rows of ``docs``, all columns, that ``judge_quality`` keeps.  Texts
    aren't written here: labelled documents are judged first, for the threshold
    (told from others by a broadcast of at most ``most_ids`` ids; beyond, all are
    judged and only their counts meet the labels)."""
    ratios, buckets = _ratios(docs, labels, id_col, text_col, buckets)
    if threshold is None:
        known = stored(labelled(labels, id_col), "labelled")
        some = docs
        if known.count() <= most_ids:
            some = docs.join(F.broadcast(known.select("_l")), docs[id_col] == F.col("_l"), "left_semi")
        scores = _judged(some, some[id_col], text_col, ratios, buckets).select(
            "_id", "_q.base_failed", "_q.ratio_sum", "_q.n_grams")
        threshold = fitted_threshold(scores, known)
    row = F.struct(*[docs[c] for c in docs.columns])
    d = _judged(docs, row, text_col, ratios, buckets)
    return d.where(_kept("_q.", threshold)).select("_id.*")
