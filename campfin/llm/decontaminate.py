"""Benchmark decontamination by pigeonhole edit matching (operator 10).

An item of m characters may occur with up to k = m // ``per_edit`` edits.  It
is split into k + 1 pieces: k edits can touch at most k of them, so one piece
stands in the text unchanged.  All pieces of all items go into one
Aho-Corasick automaton that reads each whole text once; around each hit the
item is verified with Myers' bit-parallel distance.  The search is exact: a
(document, item) pair is reported if and only if some substring of the
document is within k edits of the item.  An item under ``SHORT_CHARS``
characters says little inside a word; it counts where it stands unchanged
between word borders.

The benchmark is the query set.  It is broadcast in blocks of bounded size, and
one narrow pass over the documents searches them all: a worker takes a stretch
of bounded size of documents and goes through the blocks, of which it (like the
driver that sends them) holds one at a time.  Texts never leave their rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

PER_EDIT = 16
#: Shorter items (normalised) are matched unchanged, between word borders.
SHORT_CHARS = 24
#: Characters of items in a block, about, and of documents held while several
#: blocks are searched.
BLOCK_CHARS, HELD_CHARS = 4_000_000, 32_000_000

HIT = pa.struct([("item", pa.string()), ("distance", pa.int32()), ("end", pa.int64())])
HIT_DDL = "array<struct<item:string,distance:int,end:bigint>>"


def normalise(text: str | None) -> str:
    """Lower case, runs of white space to one space, none at the ends."""
    return " ".join((text or "").lower().split())


def cuts(m: int, pieces: int) -> list[tuple[int, int]]:
    """[start, end) of ``pieces`` nearly equal parts of ``m`` characters."""
    return [(m * i // pieces, m * (i + 1) // pieces) for i in range(pieces)]


def best_match(pattern: str, masks: dict[str, int], text: str) -> tuple[int, int]:
    """(distance, end) of the substring of ``text`` nearest to ``pattern``,
    the first end on ties; one bit per pattern character."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, now = full, 0, m
    best, end = m, 0
    for i, ch in enumerate(text, 1):
        eq = masks.get(ch, 0)
        diag = eq | down
        rise = ((((eq & up) + up) ^ up) | eq) & full
        plus = down | (full & ~(rise | up))
        minus = up & rise
        if plus & top:
            now += 1
        elif minus & top:
            now -= 1
        plus = plus << 1 & full
        minus = minus << 1 & full
        up = minus | (full & ~(diag | plus))
        down = plus & diag
        if now < best:
            best, end = now, i
    return best, end


class Searcher:
    """Finds a block of (item id, normalised text) in normalised texts."""

    def __init__(self, items: list[tuple[str, str]], per_edit: int):
        self.items = items
        self.budget = [0 if len(t) < SHORT_CHARS else len(t) // per_edit for _, t in items]
        self.masks: list[dict[str, int] | None] = [None] * len(items)
        self.automaton = ahocorasick.Automaton()
        for k, (_, t) in enumerate(items):
            for a, b in cuts(len(t), self.budget[k] + 1):
                piece = t[a:b]
                if piece in self.automaton:
                    self.automaton.get(piece).append((k, a, len(piece)))
                else:
                    self.automaton.add_word(piece, [(k, a, len(piece))])
        if items:
            self.automaton.make_automaton()

    def _masks(self, k: int) -> dict[str, int]:
        if self.masks[k] is None:
            masks: dict[str, int] = {}
            for i, ch in enumerate(self.items[k][1]):
                masks[ch] = masks.get(ch, 0) | 1 << i
            self.masks[k] = masks
        return self.masks[k]

    def find(self, text: str) -> list[tuple[str, int, int]]:
        """(item, least distance, end of its first place in the text)."""
        if not self.items or not text:
            return []
        starts: dict[int, set[int]] = {}
        for end, pieces in self.automaton.iter(text):
            for k, a, n in pieces:
                starts.setdefault(k, set()).add(end + 1 - n - a)
        out = []
        for k, places in starts.items():
            item, budget = self.items[k][1], self.budget[k]
            if len(item) < SHORT_CHARS:
                places = {s for s in places if not text[max(s - 1, 0):s].isalnum()
                          and not text[s + len(item):s + len(item) + 1].isalnum()}
                if not places:
                    continue
            exact = min((s for s in places if s >= 0 and text.startswith(item, s)), default=None)
            if exact is not None:
                out.append((self.items[k][0], 0, exact + len(item)))
                continue
            best, end = budget + 1, 0
            for lo, hi in self._windows(sorted(places), len(item), budget, len(text)):
                d, e = best_match(item, self._masks(k), text[lo:hi])
                if d < best:
                    best, end = d, lo + e
            if best <= budget:
                out.append((self.items[k][0], best, end))
        return sorted(out)

    @staticmethod
    def _windows(starts: list[int], m: int, k: int, n: int) -> Iterator[tuple[int, int]]:
        """Joined stretches that hold every match with a piece at a hit."""
        lo = hi = None
        for s in starts:
            a, b = max(0, s - k), min(n, s + m + k)
            if hi is None or a > hi:
                if hi is not None:
                    yield lo, hi
                lo, hi = a, b
            else:
                hi = max(hi, b)
        if hi is not None:
            yield lo, hi


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int
                ) -> Iterator[list[tuple[str, str]]]:
    """The distinct items in blocks of about ``block_chars`` characters."""
    src = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text")
                       ).where("item is not null and text is not null").distinct()
    total = src.agg(F.sum(F.length("text"))).collect()[0][0] or 0
    n = max(1, math.ceil(total / block_chars))
    for b in range(n):
        part = src.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b)
        rows = [(r["item"], normalise(r["text"])) for r in part.collect()]
        yield sorted(r for r in rows if r[1])


def free_name(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def annotate(docs: DataFrame, items: DataFrame, out_col: str = "hits", text_col: str = "text",
             item_col: str = "item_id", item_text: str = "text", per_edit: int = PER_EDIT,
             block_chars: int = BLOCK_CHARS) -> tuple[DataFrame, str]:
    """All columns of ``docs`` plus an array of (item, distance, end): the
    items found in the row's text, by item, each with its least distance and
    the end of that place in the normalised text.  Returns the frame and the
    name of the new column (``out_col``, or one that no column has)."""
    name = free_name(docs, out_col)
    df = docs.withColumn(name, F.array().cast(HIT_DDL))
    sc = docs.sparkSession.sparkContext
    blocks = [sc.broadcast(b) for b in item_blocks(items, item_col, item_text, block_chars) if b]
    return (_search(df, blocks, name, text_col, per_edit) if blocks else df), name


def _stretches(batches: Iterator[pa.RecordBatch], at_text: int, chars: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in groups of about so many bytes of text."""
    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            held.append(part)
            size += sum(len(x.as_buffer() or b"") for x in part.column(at_text))
            if size >= chars:
                yield held
                held, size = [], 0
    if held:
        yield held


def _search(df: DataFrame, blocks: list, name: str, text_col: str, per_edit: int) -> DataFrame:
    at_text, at_hits = df.columns.index(text_col), df.columns.index(name)

    def searchers() -> Iterator[Searcher]:
        for b in blocks:
            yield Searcher(b.value, per_edit)
            b.__dict__.pop("_value", None)  # the next block takes its place

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = Searcher(blocks[0].value, per_edit) if len(blocks) == 1 else None
        for held in _stretches(batches, at_text, 1 if only else HELD_CHARS):
            texts = [[normalise(t) for t in part.column(at_text).to_pylist()] for part in held]
            found: list[list[dict]] = [[{} for _ in part] for part in texts]
            for search in [only] if only else searchers():
                for part, hits in zip(texts, found):
                    for text, mine in zip(part, hits):
                        for item, d, e in search.find(text):
                            if item not in mine or d < mine[item]["distance"]:
                                mine[item] = {"item": item, "distance": d, "end": e}
            for part, hits in zip(held, found):
                cols = list(part.columns)
                cols[at_hits] = pa.array([[h[i] for i in sorted(h)] for h in hits], pa.list_(HIT))
                yield pa.RecordBatch.from_arrays(cols, part.schema.names)

    return df.mapInArrow(run, df.schema)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 **options) -> DataFrame:
    """One row per document: id, contaminated, n_items, least_distance (null
    without hits), items (sorted ids, comma-joined).

    Null and empty texts hold nothing and empty items are in no text; an item
    id with several texts is found by any of them; very long texts are searched
    whole; repeated rows are searched each; empty tables give no rows
    or no hits; other columns are not read.
    """
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    found, hits = annotate(src, items, "hits", **options)
    ids = F.transform(hits, lambda h: h["item"])
    return found.select(
        F.col("_id").alias(id_col), (F.size(hits) > 0).alias("contaminated"),
        F.size(hits).cast("long").alias("n_items"),
        F.array_min(F.transform(hits, lambda h: h["distance"])).alias("least_distance"),
        F.array_join(ids, ",").alias("items"))


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in whose text no item is found, all columns."""
    found, hits = annotate(docs, items, "hits", **options)
    return found.where(F.size(hits) == 0).drop(hits)
