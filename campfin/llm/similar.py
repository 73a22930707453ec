"""N-gram Jaccard self-join under several global token orders (operator 6).

A document's set holds its distinct word shingles.  Two sets of sizes a and b
that reach the threshold t share a token among the first
``n - ceil(t * n) + 1`` of each, under *any* order of all tokens.  Pairs that
share such a token under the first order are candidates; they must also share
one under every other order before they are verified.  The first order puts
tokens known to be frequent last (by an estimated count, bounded list), the
others follow different hashes: every order is the same for all documents, so
no link is lost, whatever the estimate.

Two nodes also share enough *of* their first prefixes: if A's ends first, the
tokens of A's prefix that B has are in B's prefix, so
``shared <= |A| - |prefix(A)| + shared in the prefixes``.

Scale: equal sets are one node.  Parts of the table ask buckets of tokens which
prefix tokens another node has (14 bytes a token); only those become rows.
Within a token's group of more than ``GROUP`` nodes no pairs are listed at
first: all nodes are verified against the node with the rarest own tokens,
links become components, and only pairs across components that pass the
length and position bounds follow.  Sets are fetched for candidates only.
What is collected is the bounded list of frequent tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from campfin.llm.asking import ANSWER, DIFFERS, SENT, answer, answers, known, least_by_key, send, sent
from campfin.llm.components import components, stored

WORDS = 4
PERCENT = 85
GROUP = 16
PART_ROWS, LEAST_PARTS = 4000, 8
#: Orders besides the first.
ORDERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: The frequent list: tokens seen ``LOCAL`` times among ``CHUNK`` shingles of
#: a task, ``TOTAL`` times in sum, the ``LISTED`` most frequent.
CHUNK, LOCAL, TOTAL, LISTED = 4_000_000, 2, 4, 500_000
CACHE_WORDS = 150_000
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3],
                np.uint64)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


_words = _Words()


def shingles(text: str | None, k: int = WORDS) -> np.ndarray:
    """Sorted distinct 48-bit tokens of the k-word shingles (A-Z lower-cased;
    with fewer words the whole sequence; without words none)."""
    # bytes.lower folds A-Z only, bytes.split cuts at exactly the six separators
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.int64)
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(b"\0".join(words), seed=k) >> 16], np.int64)
    if len(_words) > CACHE_WORDS:
        _words.clear()
    ids = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = len(ids) - k + 1
    h = ids[:n] * _MIX[0]
    for i in range(1, k):
        h += ids[i:i + n] * _MIX[i]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return np.unique(h >> np.uint64(16)).astype(np.int64)


def prefix_size(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1 if n else 0


def hash_prefix(tokens: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The first tokens under a hash order, sorted by token."""
    p = prefix_size(len(tokens), percent)
    if p >= len(tokens):
        return tokens
    rank = tokens.astype(np.uint64) * np.uint64(order)
    rank ^= rank >> np.uint64(29)
    rank *= np.uint64(0xBF58476D1CE4E5B9)
    return np.sort(tokens[np.argpartition(rank, p - 1)[:p]])


def first_prefix(tokens: np.ndarray, listed: np.ndarray, counts: np.ndarray, percent: int
                 ) -> np.ndarray:
    """The first tokens under the first order, in that order."""
    p = prefix_size(len(tokens), percent)
    if not len(tokens):
        return tokens
    rank = np.zeros(len(tokens), np.int64)
    if len(listed):
        at = np.minimum(np.searchsorted(listed, tokens), len(listed) - 1)
        rank = np.where(listed[at] == tokens, counts[at], 0)
    return tokens[np.lexsort((tokens, rank))[:p]]


def frequent_tokens(src: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and estimated document counts, at most ``LISTED``, by token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()

        def count() -> pa.RecordBatch:
            tok = np.concatenate(held)
            held.clear()
            tok.sort()
            # only repeated tokens are copied: each stands once less often here
            tok, n = np.unique(tok[1:][tok[1:] == tok[:-1]], return_counts=True)
            keep = n + 1 >= LOCAL
            return pa.RecordBatch.from_arrays(
                [pa.array(tok[keep]), pa.array((n[keep] + 1).astype(np.int64))], ["token", "n"])
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                for text in batch.column(1).slice(at, 500).to_pylist():
                    s = shingles(text, k)
                    sig = xxhash.xxh3_64_intdigest(s.tobytes())
                    if sig not in seen:  # copies say nothing about similar texts
                        seen.add(sig)
                        held.append(s)
                        size += len(s)
                if size >= CHUNK:
                    yield count()
                    size, seen = 0, set()
        if held:
            yield count()

    top = (src.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
           .where(F.col("n") >= TOTAL).orderBy(F.desc("n"), "token").limit(LISTED).toArrow())
    token, n = (top.column(c).to_numpy() for c in ("token", "n"))
    order = np.argsort(token)
    return token[order], n[order]


def _signatures(src: DataFrame, k: int, percent: int) -> DataFrame:
    """(_rid, n, node, prefix) of every row, written; ``node`` is null for no
    words.  The list of frequent tokens is given back when that is done."""
    shared = src.sparkSession.sparkContext.broadcast(frequent_tokens(src, k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, counts = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                n, node, prefix = [], [], []
                for text in part.column(1).to_pylist():
                    s = shingles(text, k)
                    n.append(len(s))
                    node.append(_node(s))
                    prefix.append(first_prefix(s, listed, counts, percent))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(node, pa.int64()),
                     pa.array(prefix, pa.list_(pa.int64()))], ["_rid", "n", "node", "prefix"])

    out = stored(src.mapInArrow(run, "_rid long, n long, node long, prefix array<long>"), "signatures")
    shared.destroy()
    return out


def _node(s: np.ndarray) -> int | None:
    """64-bit id of a set (two different sets share one with a chance of
    sets squared / 2^65)."""
    return None if not len(s) else xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def pack_set(s: np.ndarray) -> bytes:
    return (s & 0xFFFFFFFF).astype("<u4").tobytes() + (s >> 32).astype("<u2").tobytes()


def unpack_set(b: bytes) -> np.ndarray:
    n = len(b) // 6
    return np.frombuffer(b, "<u4", n).astype(np.int64) | np.frombuffer(b, "<u2", n, 4 * n).astype(np.int64) << 32


def _sets(src: DataFrame, wanted: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, n, set, p2, p3) of the rows in ``wanted`` (_rid)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                sets = [shingles(t, k) for t in batch.column(1).slice(at, 200).to_pylist()]
                cols = [pa.array([_node(s) for s in sets], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([pack_set(s) for s in sets], pa.binary())]
                cols += [pa.array([hash_prefix(s, o, percent) for s in sets], pa.list_(pa.int64()))
                         for o in ORDERS]
                yield pa.RecordBatch.from_arrays(cols, ["node", "n", "set", "p2", "p3"])

    return src.join(wanted, "_rid", "left_semi").select("_rid", "_text").mapInArrow(
        run, "node long, n long, set binary, p2 array<long>, p3 array<long>")


def _possible(percent: int, na, nb, ia, ib):
    """Length and position bounds: with the first shared token at places ia
    and ib at most min(na - ia, nb - ib) tokens are shared."""
    shared = F.least(na - ia, nb - ib)
    return ((100 * F.least(na, nb) >= percent * F.greatest(na, nb))
            & ((100 + percent) * shared >= percent * (na + nb)))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that share prefix tokens under every order and reach
    the threshold."""
    small = sets.select("node", "p2", "p3")
    a = small.select(F.col("node").alias("a"), F.col("p2").alias("a2"), F.col("p3").alias("a3"))
    b = small.select(F.col("node").alias("b"), F.col("p2").alias("b2"), F.col("p3").alias("b3"))
    pairs = (pairs.join(a, "a").join(b, "b")
             .where(F.arrays_overlap("a2", "b2") & F.arrays_overlap("a3", "b3")).select("a", "b"))
    a = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("set").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("set").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, na, nb, sa, sb = (c.to_pylist() if i < 4 else c for i, c in enumerate(batch.columns))
            keep, last, u = [], None, None
            for i in range(batch.num_rows):
                if x[i] != last:
                    last, u = x[i], unpack_set(sa[i].as_py())
                v = unpack_set(sb[i].as_py())
                both = np.concatenate((u, v))
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (na[i] + nb[i] - shared))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "sa", "sb").mapInArrow(
        run, "a long, b long")


def _ordered(df: DataFrame) -> DataFrame:
    return df.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _prefixes(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Of a part's distinct nodes: tokens, and node, size and place of each."""
    _, rows = np.unique(table.column("node").to_numpy(), return_index=True)
    table = table.take(pa.array(rows))
    lists = table.column("prefix").combine_chunks()
    sizes = lists.value_lengths().to_numpy()
    begin = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum()) - np.repeat(begin, sizes)
    return (lists.flatten().to_numpy(), np.repeat(table.column("node").to_numpy(), sizes),
            np.repeat(table.column("n").to_numpy(), sizes), place)


def _shared_tokens(signed: DataFrame) -> DataFrame:
    """(token, node, n, i) of the prefix tokens that several nodes have."""
    parts = max(LEAST_PARTS, -(-signed.count() // PART_ROWS))

    def ask(table: pa.Table) -> pa.Table:
        tok, node, _, _ = _prefixes(table)
        keys, first, several = least_by_key(tok, node)
        rows: list = []
        send(rows, table.column("part")[0].as_py(), DIFFERS, parts, keys, np.where(several, 0, first))
        return sent(rows)

    def emit(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["token", "node", "n", "i"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())] * 4, names)
        cols = _prefixes(left)
        keep = known(answers(right, DIFFERS), cols[0])
        return pa.table([pa.array(c[keep].astype(np.int64)) for c in cols], names)

    by_part = signed.where("node is not null").select(
        F.pmod(F.xxhash64("_rid"), F.lit(parts)).cast("int").alias("part"), "node", "n", "prefix"
    ).groupBy("part")
    told = by_part.applyInArrow(ask, SENT).groupBy("bucket").applyInArrow(answer, ANSWER)
    rows = by_part.cogroup(told.groupBy("part")).applyInArrow(
        emit, "token long, node long, n long, i long")
    return rows.groupBy("token", "node").agg(F.first("n").alias("n"), F.first("i").alias("i"))


def numbered(docs: DataFrame, columns: list[str]) -> DataFrame:
    """(_rid, _row) of every row, written once: ids that a later read of
    ``docs`` would give follow its splits, which may have changed by then."""
    return stored(docs.select(F.monotonically_increasing_id().alias("_rid"),
                              F.struct(*[docs[c] for c in columns]).alias("_row")), "numbered")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS,
            percent: int = PERCENT) -> DataFrame:
    """(_rid, id, n_shingles, root) of every row; rows with equal ``root`` are
    one class, null roots (no words) stand alone.

    ``docs`` is a table of ``numbered``."""
    rows = docs.select("_rid", F.col("_row").getField(id_col).alias("_id"),
                       F.col("_row").getField(text_col).alias("_text"))
    src = rows.select("_rid", "_text")
    signed = _signatures(src, k, percent)
    common = stored(_shared_tokens(signed), "common")
    groups = stored(common.groupBy("token").agg(
        F.count("*").alias("g"), F.min(F.struct("i", "n", "node")).alias("lead")), "groups")
    grouped = common.join(groups.select("token", "g"), "token")
    heavy = grouped.groupBy("node").agg(F.sum((F.col("g") > GROUP).cast("long")).alias("h"),
                                        F.sum((F.col("g") <= GROUP).cast("long")).alias("f"))
    shared = stored(grouped.join(heavy, "node"), "shared")

    def side(df: DataFrame, s: str) -> DataFrame:
        return df.select("token", *[F.col(c).alias(f"{s}_{c}") for c in ("node", "n", "i", "h", "f")])

    few, many = shared.where(F.col("g") <= GROUP), shared.where(F.col("g") > GROUP)
    nx, ny = F.col("x_n"), F.col("y_n")
    outside = lambda n: F.floor((percent * n + 99) / 100) - 1  # noqa: E731  tokens behind the prefix
    listed = side(few, "x").join(side(few, "y"), "token").where(
        (F.col("x_node") < F.col("y_node")) & (100 * F.least(nx, ny) >= percent * F.greatest(nx, ny)))
    listed = listed.groupBy("x_node", "y_node", "x_n", "y_n", "x_h", "y_h").agg(
        F.count("*").alias("s"),
        F.bool_or(_possible(percent, nx, ny, F.col("x_i"), F.col("y_i"))).alias("possible"))
    # Tokens of large groups aren't counted here; all of them may be shared.
    most = F.greatest(outside(nx), outside(ny)) + F.col("s") + F.least("x_h", "y_h")
    listed = listed.where((F.col("possible") | (F.least("x_h", "y_h") > 0))
                          & ((100 + percent) * most >= percent * (nx + ny))
                          ).select(F.col("x_node").alias("x"), F.col("y_node").alias("y"))
    lead = groups.where(F.col("g") > GROUP).select(
        "token", F.col("lead.node").alias("y_node"), F.col("lead.n").alias("y_n"),
        F.col("lead.i").alias("y_i"))
    starred = side(many, "x").join(lead, "token").where(
        (F.col("x_node") != F.col("y_node"))
        & _possible(percent, F.col("x_n"), F.col("y_n"), F.col("x_i"), F.col("y_i"))
    ).select(F.col("x_node").alias("x"), F.col("y_node").alias("y"))
    first = stored(_ordered(listed.unionByName(starred)), "pairs")

    asked = (first.select(F.col("a").alias("node")).unionByName(first.select(F.col("b").alias("node")))
             .unionByName(many.select("node")).distinct())
    wanted = signed.join(asked, "node", "left_semi").groupBy("node").agg(F.min("_rid").alias("_rid"))
    sets = stored(_sets(src, wanted.select("_rid"), k, percent), "sets")
    links = stored(_linked(first, sets, percent), "links")
    found = stored(components(links), "components")

    # Large groups: what one leader could not join may still link elsewhere.
    known = many.join(found, "node", "left").withColumn("c", F.coalesce("root", "node"))
    lead_c = (lead.select("token", F.col("y_node").alias("node")).join(found, "node", "left")
              .select("token", F.coalesce("root", "node").alias("lead_c")))
    known = stored(known.select("token", "node", "n", "i", "f", "c"), "known")
    minor = known.join(lead_c, "token").where("c != lead_c").select(
        "token", *[F.col(v).alias(f"x_{v}") for v in ("node", "n", "i", "f", "c")])
    every = known.join(lead_c, "token").select(
        "token", (F.col("c") != F.col("lead_c")).alias("y_minor"),
        *[F.col(v).alias(f"y_{v}") for v in ("node", "n", "i", "f", "c")])
    # A pair passes the bounds at its first shared token, so that one row of it
    # is enough; rows at later tokens mostly fail them.
    rest = minor.join(every, "token").where(
        (F.col("x_c") != F.col("y_c")) & (~F.col("y_minor") | (F.col("x_node") < F.col("y_node")))
        & _possible(percent, nx, ny, F.col("x_i"), F.col("y_i"))
    ).select(F.col("x_node").alias("x"), F.col("y_node").alias("y"))
    rest = stored(_ordered(rest).join(first, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        more = stored(_linked(rest, sets, percent), "links")
        found = stored(components(links.unionByName(more)), "components")

    ids = rows.select("_rid", "_id")
    out = signed.select("_rid", "n", "node").join(ids, "_rid")
    empty = out.where("node is null").select("_rid", "_id", "n", F.lit(None).cast("long").alias("root"))
    full = out.where("node is not null").join(found, "node", "left").select(
        "_rid", "_id", "n", F.coalesce("root", "node").alias("root"))
    return full.unionByName(empty).select(
        "_rid", F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "root")


def similar_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: id, n_shingles, component_id (the smallest id
    reachable by links, itself included).

    Null, empty and blank texts have no shingles and stand alone; very long
    texts give all their shingles; repeated rows and equal sets are linked; a null id takes its class's smallest id
    (null if there is none); an empty table gives no rows; other columns are
    not read.
    """
    rows = numbered(docs, [id_col, text_col])
    rows = stored(classes(rows, id_col, text_col, k, percent), "classes")
    least = rows.where("root is not null").groupBy("root").agg(F.min(id_col).alias("component_id"))
    full = rows.where("root is not null").join(least, "root").select(
        id_col, "n_shingles", "component_id")
    return full.unionByName(rows.where("root is null").select(
        id_col, "n_shingles", F.col(id_col).alias("component_id")))


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, one for each class: the one with the
    smallest id (nulls last; of rows with the same id the first read).  Rows
    without words all stay."""
    all_rows = numbered(docs, docs.columns)
    rows = stored(classes(all_rows, id_col, text_col, k, percent), "classes")
    kept = (rows.where("root is not null").groupBy("root")
            .agg(F.min(F.struct(F.col(id_col).isNull(), F.col(id_col), "_rid")).alias("k"))
            .select(F.col("k._rid").alias("_kept"))
            .unionByName(rows.where("root is null").select(F.col("_rid").alias("_kept"))))
    return all_rows.join(kept, F.col("_rid") == F.col("_kept"), "left_semi").select("_row.*")
