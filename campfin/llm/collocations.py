"""Phrase collocation mining (operator 11): multikey three-way quicksort of
suffix pointers.

A *suffix* is what follows a word of a piece, cut after ``MOST_WORDS`` words.
Two scans:

1. words are counted per language, and prefixes that hold more than a
   ``1 / REPORT`` of what a task has in hand are reported (estimated from every
   ``EVERY``-th suffix; they only decide routes);
2. suffixes are routed by their leading two words, so that all suffixes of a
   phrase meet in one part.  Equal suffixes are counted before they are sent.
   Where a prefix is too heavy for one part, its suffixes are routed by one word
   more, and counts of the shorter prefix are partial sums that are added up
   afterwards.

In a part, pointers to suffixes are sorted by a multikey quicksort: at each
depth they are split into those below, at and above a pivot word.  The size of
the equal split is the count of the phrase so far; it goes on at the next
depth, and splits smaller than the least count are abandoned.

Words are 64-bit hashes (words to eight bytes are told apart exactly); a message
carries the hashes of its own words once, and its suffixes as numbers into that
list.  Parts hold about ``PART`` suffixes, so their number grows with the
corpus and neither a task nor the driver holds more.  Frequent phrases are
distributed rows from there on: scores, contained phrases and ranks are
DataFrame operations with decimal arithmetic.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from campfin.llm.components import stored

MOST_WORDS, LEAST, TOP = 5, 100, 2000
#: Suffixes a part, words a task holds before it sends, bytes tokenised at once.
PART, HELD_WORDS, SLICE = 2_000_000, 1_500_000, 2 << 20
#: A prefix is reported from that share of the suffixes in hand on.
REPORT, EVERY = 16384, 4
#: Salts of the first of two top-k passes.
SALTS = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)  # 0 of a word, 1 blank, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 10, 11, 12, 13]] = 2
_SEPARATOR = re.compile(rb"[.,;:!?\n-\r]")
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _K1
    x ^= x >> np.uint64(32)
    x *= _K2
    x ^= x >> np.uint64(29)
    return x


def _cuts(b: bytes) -> Iterator[bytes]:
    """A long text in slices that end with a separator."""
    at = 0
    while len(b) - at > SLICE:
        m = _SEPARATOR.search(b, at + SLICE)
        end = m.end() if m else len(b)
        yield b[at:end]
        at = end
    yield b[at:]


class Slice:
    """The words of some text: lower-cased bytes, begins, ends, hashes, and how
    many words of the piece are left from each on (itself included)."""

    def __init__(self, texts: list[bytes]):
        raw = b"\n".join(texts)
        self.raw = _LOWER[np.frombuffer(raw + b"\n" + bytes(8), np.uint8)]
        kind = _KIND[self.raw]
        kind[len(raw):] = 2
        edge = np.flatnonzero(np.diff((kind == 0).view(np.int8), prepend=0, append=0))
        self.begin, self.end = edge[::2], edge[1::2]
        piece = np.cumsum(kind == 2, dtype=np.int32)[self.begin]
        n = len(piece)
        last = np.flatnonzero(np.diff(piece, append=-1)) if n else np.zeros(0, int)
        self.left = np.repeat(last, np.diff(last, prepend=-1)) - np.arange(n) + 1
        self.left = np.minimum(self.left, MOST_WORDS).astype(np.int8)
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        size = self.end - self.begin
        at8 = np.ndarray((len(self.raw) - 7,), "<u8", self.raw, strides=(1,))
        h = size.astype(np.uint64)
        rows = np.arange(len(size))
        for c in range(0, 64, 8):
            if c:
                rows = rows[size[rows] > c]
            if not len(rows):
                break
            rest = np.minimum(size[rows] - c, 8).astype(np.uint64)
            chunk = at8[self.begin[rows] + c] & (~np.uint64(0) >> (np.uint64(64) - rest * np.uint64(8)))
            # Equal sizes meet equal chunks only: one chunk is mixed without loss.
            h[rows] = _mixed((h[rows] << np.uint64(56) | h[rows] >> np.uint64(8)) ^ chunk if c
                             else chunk ^ h[rows] << np.uint64(60))
        for i in np.flatnonzero(size > 64):
            word = self.raw[self.begin[i]:self.end[i]].tobytes()
            h[i] = np.frombuffer(blake2b(word, digest_size=8).digest(), "<u8")[0]
        h[h == 0] = 1  # 0 ends a suffix
        return h

    def word(self, i: int) -> str:
        return self.raw[self.begin[i]:self.end[i]].tobytes().decode("utf-8", "replace")


class Held:
    """Slices of one language that a task has in hand."""

    def __init__(self):
        self.slices: list[Slice] = []
        self.texts: list[bytes] = []
        self.waiting = self.words = 0

    def add(self, text: bytes) -> None:
        for part in _cuts(text):
            self.texts.append(part)
            self.waiting += len(part) + 1
            if self.waiting >= SLICE:
                self.settle()

    def settle(self) -> None:
        if self.texts:
            s = Slice(self.texts)
            self.slices.append(s)
            self.words += len(s.hash)
            self.texts, self.waiting = [], 0

    def columns(self) -> tuple[np.ndarray, np.ndarray]:
        return (np.concatenate([s.hash for s in self.slices]), np.concatenate([s.left for s in self.slices]))


def held_batches(batches: Iterator[pa.RecordBatch], words: int = HELD_WORDS) -> Iterator[tuple[str, Held]]:
    """(lang, held) of (lang, text) batches whenever enough is in hand."""
    held: dict[str, Held] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            some = batch.slice(at, 500)
            for lang, text in zip(some.column(0).to_pylist(), some.column(1)):
                b = text.as_buffer()
                held.setdefault(lang, Held()).add(b.to_pybytes() if b is not None else b"")
            if sum(h.words for h in held.values()) >= words:
                yield from _settled(held)
                held = {}
    yield from _settled(held)


def _settled(held: dict[str, Held]) -> Iterator[tuple[str, Held]]:
    for lang, h in held.items():
        h.settle()
        if h.words:
            yield lang, h


def lang_seed(lang: str) -> np.uint64:
    return np.frombuffer(blake2b(lang.encode("utf-8", "replace"), digest_size=8).digest(), "<u8")[0]


def prefixes(h: np.ndarray, left: np.ndarray, at: np.ndarray, seed: np.uint64) -> dict[int, np.ndarray]:
    """Hashes of the first 2, 3, ... words of the suffixes at positions ``at``."""
    out, now = {}, np.full(len(at), seed, np.uint64)
    for k in range(MOST_WORDS):
        w = h[np.minimum(at + k, len(h) - 1)]
        w = np.where(left[at] > k, w, np.uint64(0))
        now = _mixed(now ^ w + np.uint64(k + 1))
        if k:
            out[k + 1] = now
    return out


# -- scan 1: words and heavy prefixes -------------------------------------------


def _counted(lang: str, held: Held) -> Iterator[pa.RecordBatch]:
    h, left = held.columns()
    found, first, n = np.unique(h, return_index=True, return_counts=True)
    starts = np.cumsum([0] + [len(s.hash) for s in held.slices])
    of = np.searchsorted(starts, first, side="right") - 1
    names = [held.slices[k].word(i) for k, i in zip(of.tolist(), (first - starts[of]).tolist())]
    keys, counts, depth = [found], [n], [np.zeros(len(found), np.int32)]
    at = np.flatnonzero(left >= 2)[::EVERY]
    for d, p in prefixes(h, left, at, lang_seed(lang)).items():
        if d < MOST_WORDS and len(at):
            u, c = np.unique(p, return_counts=True)
            heavy = c >= max(8, len(at) // REPORT)
            keys.append(u[heavy])
            counts.append(c[heavy] * EVERY)
            depth.append(np.full(heavy.sum(), d, np.int32))
            names += [None] * int(heavy.sum())
    total = sum(map(len, keys))
    yield pa.RecordBatch.from_arrays(
        [pa.array([lang] * total, pa.string()), pa.array(np.concatenate(depth)),
         pa.array(np.concatenate(keys).view(np.int64)), pa.array(names, pa.string()),
         pa.array(np.concatenate(counts).astype(np.int64))], ["lang", "depth", "key", "word", "n"])


def count_words(texts: DataFrame) -> DataFrame:
    """(lang, depth, key, word, n) of (lang, text): every word at depth 0, and
    estimates of heavy prefixes at depth 2 to 4."""
    def run(batches):
        for lang, held in held_batches(batches):
            yield from _counted(lang, held)

    return (texts.mapInArrow(run, "lang string, depth int, key long, word string, n long")
            .groupBy("lang", "depth", "key", "word").agg(F.sum("n").alias("n")))


# -- scan 2: suffixes to parts ----------------------------------------------------


def _message(words: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> tuple[int, bytes]:
    """(size, compressed) of suffixes given as numbers into ``words``."""
    mark = np.zeros(len(words) + 1, bool)
    mark[ids] = True
    mark[0] = False
    own = np.flatnonzero(mark)
    new = np.zeros(len(words) + 1, np.int64)
    new[own] = np.arange(1, len(own) + 1)
    kind = "<u2" if len(own) < 65535 else "<u4"
    raw = (np.array([len(counts), len(own)], "<i8").tobytes() + words[own - 1].astype("<u8").tobytes()
           + new[ids].astype(kind).T.tobytes() + counts.astype("<u4").tobytes())
    return len(raw), pa.compress(raw, "zstd", asbytes=True)


def read_message(size: int, blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = pa.decompress(blob, size, "zstd", asbytes=True)
    n, v = np.frombuffer(raw, "<i8", 2)
    words = np.frombuffer(raw, "<u8", v, 16)
    kind = "<u2" if v < 65535 else "<u4"
    at = 16 + 8 * v
    ids = np.frombuffer(raw, kind, n * MOST_WORDS, at).reshape(MOST_WORDS, n)
    counts = np.frombuffer(raw, "<u4", n, at + ids.nbytes)
    return words, ids, counts


def routes(p: dict[int, np.ndarray], hot: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(words routed by, route): the fewest leading words, two at least, that
    are no hot prefix."""
    level = np.full(len(p[2]), 2, np.int64)
    route = p[2].copy()
    for d in range(2, MOST_WORDS):
        heavy = hot.get(d, np.zeros(0, np.uint64))
        more = np.flatnonzero((level == d) & np.isin(p[d], heavy)) if len(heavy) else []
        if len(more):
            level[more] = d + 1
            route[more] = p[d + 1][more]
    return level, route


def _sent(lang: str, held: Held, parts: int, hot: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    h, left = held.columns()
    held.slices = []
    at = np.flatnonzero(left >= 2)
    if not len(at):
        return
    p = prefixes(h, left, at, lang_seed(lang))
    _, first, counts = np.unique(p[MOST_WORDS], return_index=True, return_counts=True)
    level, route = routes({d: x[first] for d, x in p.items()}, hot)
    at = at[first]
    del p
    words, ids = np.unique(h, return_inverse=True)
    group = (route >> np.uint64(24)) % np.uint64(parts) * np.uint64(8) + level.astype(np.uint64)
    order = np.argsort(group, kind="stable")
    group, at, counts = group[order], at[order], counts[order]
    ids = np.append(ids.astype(np.int32) + 1, 0)
    ends = np.append(np.flatnonzero(np.diff(group)) + 1, len(group))
    rows: list[tuple] = []
    begin = 0
    for end in ends.tolist():
        a = at[begin:end]
        suffix = np.stack([np.where(left[a] > k, ids[np.minimum(a + k, len(h))], 0) for k in range(MOST_WORDS)], 1)
        size, blob = _message(words, suffix, counts[begin:end])
        rows.append((int(group[begin]) // 8, lang, int(group[begin]) % 8, size, blob))
        begin = end
        if len(rows) >= 256:
            yield _rows(rows)
            rows = []
    if rows:
        yield _rows(rows)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.binary()])],
        ["part", "lang", "level", "size", "blob"])


# -- in a part --------------------------------------------------------------------


def quicksort(columns: list[np.ndarray], weight: np.ndarray, least: list[int]
              ) -> list[tuple[tuple[int, ...], int]]:
    """(phrase, count) of every prefix of two words or more with a count of
    ``least[its words]`` or more.  ``columns[d]`` holds word d of each suffix,
    0 past its end; pointers to suffixes are split by a pivot word."""
    found: list[tuple[tuple[int, ...], int]] = []
    stack = [(np.arange(len(weight)), 0, ())]
    while stack:
        at, depth, phrase = stack.pop()
        need = least[depth + 1]
        while len(at):
            v = columns[depth][at]
            n = len(v)
            pivot = v[0] if n < 8 else sorted((v[0], v[n // 4], v[n // 2], v[3 * n // 4], v[-1]))[2]
            same = v == pivot
            equal = at[same]
            if pivot:
                count = int(weight[equal].sum())
                if count >= need:
                    now = (*phrase, int(pivot))
                    if depth:
                        found.append((now, count))
                    if depth + 1 < len(columns):
                        stack.append((equal, depth + 1, now))
            below, above = at[v < pivot], at[v > pivot]
            if int(weight[below].sum()) >= need:
                if int(weight[above].sum()) >= need:
                    stack.append((above, depth, phrase))
                at = below
            elif int(weight[above].sum()) >= need:
                at = above
            else:
                break
    return found


def part_phrases(messages: list[tuple[int, bytes]], level: int, least: int
                 ) -> list[tuple[list[int], int]]:
    """(word hashes, count) of one language's messages of one route length.
    Prefixes shorter than the route are partial, so none of theirs is small."""
    read = [read_message(*m) for m in messages]
    words, back = np.unique(np.concatenate([w for w, _, _ in read]), return_inverse=True)
    columns: list[list[np.ndarray]] = [[] for _ in range(MOST_WORDS)]
    at = 0
    for w, ids, _ in read:
        to = np.append(0, back[at:at + len(w)] + 1).astype(np.int32)
        at += len(w)
        for k in range(MOST_WORDS):
            columns[k].append(to[ids[k]])
    weight = np.concatenate([c for _, _, c in read]).astype(np.int64)
    need = [0] + [1 if d < level else least for d in range(1, MOST_WORDS + 1)]
    need[1] = 1  # single words are counted elsewhere, and here for some parts only
    if level == 2:
        need[1] = least  # a split below the least holds no phrase either
    signed = words.view(np.int64)
    return [([int(signed[x - 1]) for x in phrase], n)
            for phrase, n in quicksort([np.concatenate(c) for c in columns], weight, need)]


def count_phrases(texts: DataFrame, total: int, hot: dict[int, list[int]], least: int = LEAST,
                  part: int = PART) -> DataFrame:
    """(lang, w: word hashes, f) of every phrase of 2 to ``MOST_WORDS`` words
    that occurs ``least`` times or more in (lang, text)."""
    parts = max(1, -(-total // part))
    heavy = {d: np.sort(np.array(x, np.int64).view(np.uint64)) for d, x in hot.items()}

    def send(batches):
        for lang, held in held_batches(batches):
            yield from _sent(lang, held, parts, heavy)

    def count(table: pa.Table) -> pa.Table:
        by: dict[tuple[str, int], list] = {}
        for _, lang, level, size, blob in zip(*[c.to_pylist() for c in table.columns]):
            by.setdefault((lang, level), []).append((size, blob))
        out: list[tuple] = []
        for (lang, level), messages in by.items():
            out += [(lang, w, n) for w, n in part_phrases(messages, level, least)]
        lang, w, n = zip(*out) if out else ((), (), ())
        return pa.table([pa.array(lang, pa.string()), pa.array(w, pa.list_(pa.int64())), pa.array(n, pa.int64())],
                        ["lang", "w", "f"])

    return (texts.mapInArrow(send, "part int, lang string, level int, size long, blob binary")
            .groupBy("part").applyInArrow(count, "lang string, w array<long>, f long")
            .groupBy("lang", "w").agg(F.sum("f").alias("f")).where(F.col("f") >= least))


# -- scores -----------------------------------------------------------------------


def contained(phrases: DataFrame) -> DataFrame:
    """Phrases (lang, w) that a longer frequent phrase holds with the same
    count.  One word more is enough: what is in between occurs as often."""
    longer = phrases.where(F.size("w") > 2).select(
        "lang", F.col("f").alias("_f"),
        F.explode(F.array(F.expr("slice(w, 1, size(w) - 1)"), F.expr("slice(w, 2, size(w) - 1)"))).alias("w"))
    most = longer.groupBy("lang", "w").agg(F.max("_f").alias("_f"))
    return phrases.join(most, ["lang", "w"]).where("_f >= f").select("lang", "w")


def scored(phrases: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, w, a, l, r, n, score) of every candidate by its weakest cut."""
    every = phrases.select("lang", "w", "f").unionByName(
        words.select("lang", F.array("key").alias("w"), F.col("n").alias("f")))
    mine = phrases.join(contained(phrases), ["lang", "w"], "left_anti")
    cuts = mine.select("lang", "w", F.col("f").alias("a"),
                       F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.withColumns({"_l": F.expr("slice(w, 1, k)"), "_r": F.expr("slice(w, k + 1, size(w) - k)")})
    left, right = (every.select("lang", F.col("w").alias(f"_{x}"), F.col("f").alias(x)) for x in "lr")
    cuts = cuts.join(left, ["lang", "_l"]).join(right, ["lang", "_r"]).join(F.broadcast(totals), "lang")

    def big(c: str):
        return F.col(c).cast("decimal(19,0)")

    cuts = cuts.withColumns({"_up": F.lit(1000).cast("decimal(4,0)") * big("a") * big("n"),
                             "_low": big("l") * big("r")})
    best = F.min(F.struct(F.expr("_up div _low").alias("score"), "k", "l", "r")).alias("b")
    return cuts.groupBy("lang", "w", "a", "n").agg(best).select(
        "lang", "w", "a", "b.l", "b.r", "n", "b.score")


def mine_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                 top: int = TOP, part: int = PART) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r,
    n, score, by score and count descending, then phrase.

    Null languages are ``und``; null and empty texts have no words.  Very long
    texts are cut at separators, which no phrase crosses.  Repeated rows count
    each.  Ties in score and count are told by the phrase's UTF-8 bytes.  An
    empty table gives no rows; other columns are not read.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counted = stored(count_words(texts), "words")
    words = counted.where("depth = 0")
    totals = stored(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    total = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # At most 4 * REPORT prefixes a depth can hold that share of all suffixes.
    heavy = counted.where(F.col("depth") > 0).where(F.col("n") >= max(part // 4, total // (4 * REPORT)))
    hot: dict[int, list[int]] = {}
    for r in heavy.select("depth", "key").collect():
        hot.setdefault(r["depth"], []).append(r["key"])
    words = words.where(F.col("n") >= least).select("lang", "key", "word", "n")
    phrases = stored(count_phrases(texts, total, hot, least, part), "phrases")
    best = scored(phrases, words, totals)
    order = [F.col("score").desc(), F.col("a").desc()]
    salt = F.pmod(F.xxhash64("w"), F.lit(SALTS))
    # Two passes of ranks with ties, so that no task sorts a whole language.
    for keys in (["lang", salt], ["lang"]):
        best = best.withColumn("_k", F.rank().over(Window.partitionBy(*keys).orderBy(*order))).where(
            F.col("_k") <= top).drop("_k")
    named = (best.select("*", F.posexplode("w").alias("_p", "key"))
             .join(words.select("lang", "key", "word"), ["lang", "key"])
             .groupBy("lang", "w", "a", "l", "r", "n", "score")
             .agg(F.expr("array_join(transform(sort_array(collect_list(struct(_p, word))), x -> x.word), ' ')")
                  .alias("phrase")))
    last = Window.partitionBy("lang").orderBy(*order, F.col("phrase").asc())
    return (named.withColumn("rank", F.row_number().over(last).cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
