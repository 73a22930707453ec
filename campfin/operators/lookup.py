"""Key lookups of a large side against a side with unique keys.

Strategy, chosen per lookup table:

* broadcast hash join when the lookup's rows and their measured bytes are under
  checked bounds (``campfin.broadcast.maxRows`` / ``.maxBytes``);
* otherwise a shuffle join beside which **heavy keys** pass.  A sketch of bounded
  size (``approx_top_k``) over the large side's keys tells which keys hold more
  than their share of rows; their lookup rows, a hundred at most where lookup
  keys are unique, are broadcast to the rows that hold them, which are not
  shuffled.  Where a heavy key has more lookup rows than that, its rows pick one
  of ``campfin.salt.buckets`` buckets, and the key's lookup rows are copied into
  all of them.  A conduit committee holding a third of all contributions stays
  where it is; AQE does the rest.

Keys that can match nothing don't travel: a NULL key never equals anything, and
an empty text only where the lookup holds one (seen when it is measured).  In
left and anti joins such rows pass beside the shuffle join too.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campfin.session import scratch_path, shared_dir

DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20
DEFAULT_SALT_BUCKETS = 16
#: A key is heavy from this share of the large side's rows on; the sketch holds
#: a fixed number of keys, well above 1 / share.
HEAVY_SHARE, HEAVY_KEYS, SKETCH_ITEMS = 0.01, 100, 2000
#: Bytes of a row and of each column that is no text.
_ROW_BYTES, _CELL_BYTES, _TEXT_BYTES = 24, 16, 24


def _conf_int(df: DataFrame, key: str, default: int) -> int:
    return int(df.sparkSession.conf.get(key, str(default)))


def _is_text(f: T.StructField) -> bool:
    return isinstance(f.dataType, T.StringType)


def _row_bytes(df: DataFrame) -> Column:
    size = F.lit(_ROW_BYTES)
    for f in df.schema.fields:
        size = size + (F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) if _is_text(f) else F.lit(_CELL_BYTES))
    return size


def _measures(df: DataFrame) -> list[Column]:
    """Rows, bytes, and for every text column whether it holds ''."""
    out = [F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(df)).alias("bytes")]
    return out + [F.max(F.col(f.name) == "").alias(f"empty_{f.name}") for f in df.schema.fields if _is_text(f)]


@dataclass
class Lookup:
    """A lookup table plus the join strategy decided for it."""
    df: DataFrame
    broadcast: bool
    salt_buckets: int
    rows: int = -1
    #: Text columns known to hold no ''.
    never_empty: frozenset = field(default_factory=frozenset)

    @classmethod
    def of(cls, df: DataFrame, max_rows: int | None = None,
           salt_buckets: int | None = None, materialize: bool = False,
           rows: int | None = None) -> "Lookup":
        """Decide the strategy for ``df``.

        ``materialize`` writes ``df`` to the shared folder first when it is
        derived from a large input, so that the size check and the join do not
        both recompute it; it is measured while written.  ``rows`` is a row
        count already known (then no job runs, and bytes follow from the
        column types)."""
        max_rows = max_rows if max_rows is not None else _conf_int(
            df, "campfin.broadcast.maxRows", DEFAULT_MAX_BROADCAST_ROWS)
        max_bytes = _conf_int(df, "campfin.broadcast.maxBytes", DEFAULT_MAX_BROADCAST_BYTES)
        buckets = salt_buckets or _conf_int(df, "campfin.salt.buckets", DEFAULT_SALT_BUCKETS)
        if rows is not None and not materialize:
            width = _ROW_BYTES + sum(_TEXT_BYTES if _is_text(f) else _CELL_BYTES for f in df.schema.fields)
            return cls(df, rows <= max_rows and rows * width <= max_bytes, buckets, rows)
        if materialize:
            seen = Observation(f"campfin-lookup-{uuid.uuid4().hex}")
            df = written(df.observe(seen, *_measures(df)), "lookup")
            got = seen.get
        else:
            got = df.agg(*_measures(df)).first().asDict()  # partial sums, no row leaves its task
        size = got["bytes"] or 0
        never = frozenset(k[6:] for k, v in got.items() if k.startswith("empty_") and not v)
        return cls(df, got["rows"] <= max_rows and size <= max_bytes, buckets, got["rows"], never)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives
    lost executors, and later reads take only the columns they need."""
    spark = df.sparkSession
    shared_dir(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def heavy_keys(big: DataFrame, keys: list[tuple[str, ...]], share: float = HEAVY_SHARE
               ) -> dict[tuple[str, ...], list[int]]:
    """For each of several key column lists, the hashes of the keys that hold at
    least ``share`` of the rows, at most ``HEAVY_KEYS`` each: one pass over the
    key columns with sketches of fixed size."""
    hashed = big.select(*[F.xxhash64(F.struct(*[F.col(c) for c in k])).alias(f"h{i}") for i, k in enumerate(keys)])
    tops = [F.expr(f"approx_top_k(h{i}, {HEAVY_KEYS}, {SKETCH_ITEMS})").alias(f"top{i}") for i in range(len(keys))]
    got = hashed.agg(F.count(F.lit(1)).alias("n"), *tops).first()
    return {k: [t["item"] for t in got[f"top{i}"] or [] if t["count"] >= max(share * got["n"], 2)]
            for i, k in enumerate(keys)}


def lookup(big: DataFrame, table: Lookup, on: list[tuple[str, str]],
           take: dict[str, str], how: str = "left",
           salt_cols: list[str] | None = None, heavy: list[int] | None = None) -> DataFrame:
    """Join ``big`` to ``table`` on ``big[a] == table[b]`` for (a, b) in ``on``
    and add ``table`` columns as ``take`` = {output name: table column}.

    ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``; ``heavy``:
    hashes of heavy keys already measured (``heavy_keys``).
    """
    keys = [(a, f"_lk{i}") for i, (a, _b) in enumerate(on)]
    sel = [F.col(b).alias(f"_lk{i}") for i, (_a, b) in enumerate(on)]
    sel += [F.col(src).alias(dst) for dst, src in take.items()]
    right = table.df.select(*sel)
    if table.broadcast:
        cond = _cond(big, right, keys)
        out = big.join(F.broadcast(right), cond, how)
        return out.drop(*[k for _a, k in keys]) if how in ("left", "inner") else out
    columns = big.columns
    hopeless = _hopeless(big, table, on)
    travelling = big.where(~hopeless)
    names = tuple(a for a, _k in keys)
    heavy = heavy_keys(travelling, [names])[names] if heavy is None else heavy
    beside = hopeless
    few = None
    if heavy:
        is_heavy = F.coalesce(_hashed(big, keys, [a for a, _k in keys]).isin(heavy), F.lit(False))
        hot = right.where(_hashed(big, keys, [k for _a, k in keys]).isin(heavy))
        if hot.limit(HEAVY_KEYS + 1).count() <= HEAVY_KEYS:
            few, heavy = hot, []
            beside = hopeless | is_heavy
            travelling = big.where(~beside)
    n = table.salt_buckets
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in salt_cols or columns]), F.lit(n)).cast("int")
    big_hash, right_hash = (_hashed(big, keys, cs) for cs in ([a for a, _k in keys], [k for _a, k in keys]))
    salted = travelling.withColumn("_salt", F.when(big_hash.isin(heavy), spread).otherwise(0) if heavy else F.lit(0))
    all_buckets, one = F.sequence(F.lit(0), F.lit(n - 1)), F.array(F.lit(0))
    copied = right.withColumn("_rsalt", F.explode(F.when(right_hash.isin(heavy), all_buckets).otherwise(one)
                                                  if heavy else one))
    cond = _cond(salted, copied, keys) & (salted["_salt"] == copied["_rsalt"])
    out = salted.join(copied, cond, how).drop("_salt")
    if how in ("left", "inner"):
        out = out.drop("_rsalt", *[k for _a, k in keys])
    if few is not None:  # rows without a match in it pass too, where the join keeps them
        rest = big.where(beside if how in ("left", "left_anti") else is_heavy)
        met = rest.join(F.broadcast(few), _cond(rest, few, keys), how)
        out = out.unionByName(met.select(*out.columns))
    elif how == "left":
        out = out.unionByName(big.where(hopeless).select(
            *columns, *[F.lit(None).cast(table.df.schema[src].dataType).alias(dst) for dst, src in take.items()]))
    elif how == "left_anti":
        out = out.unionByName(big.where(hopeless).select(*columns))
    return out


def _hashed(big: DataFrame, keys, columns: list[str]) -> Column:
    """The hash of a key as ``heavy_keys`` makes it."""
    return F.xxhash64(F.struct(*[F.col(c).cast(big.schema[a].dataType) for c, (a, _k) in zip(columns, keys)]))


def _hopeless(big: DataFrame, table: Lookup, on: list[tuple[str, str]]) -> Column:
    """Whether a row's key can match nothing."""
    out = F.lit(False)
    for a, b in on:
        out = out | F.col(a).isNull()
        if b in table.never_empty and _is_text(big.schema[a]):
            out = out | (F.col(a) == "")
    return F.coalesce(out, F.lit(True))


def _cond(big: DataFrame, right: DataFrame, keys) -> Column:
    cond = None
    for a, k in keys:
        term = big[a] == right[k]
        cond = term if cond is None else cond & term
    return cond
