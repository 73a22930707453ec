"""Secret scans with one combined automaton (operator 9).

Every rule has a *trigger*, an expression that lies in each of its matches.
All triggers are compiled into one minimal deterministic automaton that reads
each text once, byte by byte.  Where it accepts, the stretch around that byte
made of the rule's own characters is matched with the rule's automaton:
leftmost, longest, not overlapping.  A match never leaves such a stretch, so
this equals matching the rule over the whole text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import length_hint

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from campfin.llm.automaton import Automaton, compile_rules


@dataclass(frozen=True)
class SecretRule:
    """``head`` + ``rest`` is the rule; matches are the longest ones.  One is
    kept if it has ``least`` characters, after the head where ``after_head``.
    ``fold`` matches the head's letters in either case.  ``trigger`` follows
    the head in the trigger expression (part of every kept match)."""

    kind: str
    head: str
    rest: str
    least: int
    trigger: str
    after_head: bool = False
    fold: bool = False


VALUE = "[A-Za-z0-9+/_.=-]"
#: The base rules.
BASE = (
    SecretRule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""",
               VALUE + "+", 12, VALUE + "{4}", after_head=True, fold=True),
    SecretRule("access", "AKIA", "[A-Z0-9]+", 18, "[A-Z0-9]{4}"),
    SecretRule("hex", "", "[0-9a-f]+", 16, "[0-9a-f]{8}"),
)
#: Public token formats besides.
MORE = (
    SecretRule("github", "gh[pousr]_", "[A-Za-z0-9]+", 40, "[A-Za-z0-9]{4}"),
    SecretRule("slack", "xox[abprs]-", "[A-Za-z0-9-]+", 20, "[A-Za-z0-9-]{4}"),
    SecretRule("google", "AIza", "[A-Za-z0-9_-]+", 39, "[A-Za-z0-9_-]{4}"),
    SecretRule("private_key", "-----BEGIN ", "([A-Z]+ ){0,3}PRIVATE KEY-----", 27, ""),
)


class _Hit:
    """A state in which triggers end; not to be indexed, so that the scanning
    loop leaves by an error instead of asking at every byte."""

    def __init__(self, mask: int, row: list):
        self.mask, self.row = mask, row


class Scanner:
    def __init__(self, rules: tuple[SecretRule, ...]):
        self.rules = rules
        triggers = compile_rules([(r.head + (r.trigger or r.rest), r.fold) for r in rules], True)
        self.n_states = len(triggers.accepts)
        rows = [[] for _ in triggers.accepts]
        nodes = [_Hit(m, row) if m else row for m, row in zip(triggers.accepts, rows)]
        for row, step in zip(rows, triggers.step.tolist()):
            row.extend(nodes[step[k]] for k in triggers.klass.tolist())
        self.start = rows[0]
        self.whole = [compile_rules([(r.head + r.rest, r.fold)], False) for r in rules]
        self.heads = [compile_rules([(r.head, r.fold)], False) if r.after_head else None
                      for r in rules]
        self.alphabet = [_alphabet(a) for a in self.whole]
        self.firsts = [frozenset(b for b in range(256) if a.rows[0][a.klass_bytes[b]] >= 0)
                       for a in self.whole]

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule number, end) in bytes, sorted."""
        out: list[tuple[int, int, int]] = []
        done = [0] * len(self.rules)
        it, row, n = iter(data), self.start, len(data)
        while True:
            try:
                for b in it:
                    row = row[b]
            except TypeError:
                hit, last = row, b
                self._resolve(hit.mask, data, n - length_hint(it) - 2, done, out)
                row = hit.row[last]
                continue
            if isinstance(row, _Hit):
                self._resolve(row.mask, data, n - 1, done, out)
            return sorted(out)

    def _resolve(self, mask: int, data: bytes, at: int, done: list[int], out: list) -> None:
        for k, rule in enumerate(self.rules):
            if not mask >> k & 1 or at < done[k]:
                continue
            chars, lo, hi = self.alphabet[k], at, at + 1
            while lo > done[k] and data[lo - 1] in chars:
                lo -= 1
            while hi < len(data) and data[hi] in chars:
                hi += 1
            done[k] = hi
            whole, firsts = self.whole[k], self.firsts[k]
            while lo < hi:
                if data[lo] not in firsts or (end := whole.longest(data, lo, hi)) < 0:
                    lo += 1
                    continue
                from_ = self.heads[k].longest(data, lo, end) if rule.after_head else lo
                if end - from_ >= rule.least:
                    out.append((lo, k, end))
                lo = end


def _alphabet(a: Automaton) -> frozenset:
    used = {c for row in a.rows for c, t in enumerate(row) if t >= 0}
    return frozenset(b for b in range(256) if a.klass_bytes[b] in used)


_SCANNERS: dict[tuple, Scanner] = {}


def scanner(rules: tuple[SecretRule, ...]) -> Scanner:
    if rules not in _SCANNERS:
        _SCANNERS[rules] = Scanner(rules)
    return _SCANNERS[rules]


def find_secrets(docs: DataFrame, rules: tuple[SecretRule, ...] = BASE + MORE,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ``found``, an array of (start, end, kind)
    in code points (end exclusive), sorted by start, then rule order.

    Null and empty texts: none found; very long ones are scanned whole.
    Repeated rows are scanned each; an empty table gives no rows; other columns
    are not read.  One narrow pass with one read of each text, no shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scanner(rules)
        span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = []
                for text in part.column(1).to_pylist():
                    text = text or ""
                    data = text.encode("utf-8", "replace")
                    spans = s.spans(data)
                    if spans and not text.isascii():
                        spans = _code_points(data, spans)
                    found.append([{"start": a, "end": b, "kind": rules[k].kind}
                                  for a, k, b in spans])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.list_(span))], ["_id", "found"])

    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = src.schema["_id"].dataType.simpleString()
    return src.mapInArrow(
        run, f"_id {kind}, found array<struct<start:bigint,end:bigint,kind:string>>"
    ).withColumnRenamed("_id", id_col)


def _code_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte spans (sorted by start) to code point spans; they hold ASCII only."""
    out, at, chars = [], 0, 0
    for a, k, b in spans:
        chars += len(data[at:a].decode("utf-8", "replace"))
        at = a
        out.append((chars, k, chars + b - a))
    return out


def span_text(found):
    """``kind:start:end`` of the spans, comma-joined, as a column."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per base kind, the hash of the base spans, and all spans."""
    base = F.filter("found", lambda s: s["kind"].isin([r.kind for r in BASE]))

    def count(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(r.kind).alias(f"n_{r.kind}") for r in BASE]
    return found.select(id_col, *counts, F.sha2(span_text(base), 256).alias("base_sha256"),
                        span_text(F.col("found")).alias("spans"))


def hex_digest(spans: list[tuple[str, int, int]]) -> str:
    """The same hash in Python (tests)."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
