"""Conversation structure repair (operator 13): the cheapest edits that make a
conversation's roles read ``(s?(ua)+)?``, ties decided by the audit text.

A conversation is a path through a graph whose nodes are (row, role state):
at the start, after a system, a user or an assistant turn.  Every edge of a row
inserts up to two empty turns and then deletes, keeps or re-roles the row.
**One integer is the whole weight of an edge**: its high digits hold the cost,
and each row owns a field of three base-8 digits below them that spells the
edge's letters (D, I, K, R as 1 to 4), padded with zeros at the end.  Letters
before a row's own letter are all I, so no field's text begins another's, and
the numeric order of two sums is the order of their costs and then the ASCII
order of their audits.  The ordinary minimum of integers decides everything.

Integers stay short however long a conversation is: rows are taken in blocks of
``BLOCK`` from the end, and what follows a block enters it as its cost and, in
the lowest digit, its rank among the (at most four) continuations.

Rows are shuffled once, by conversation, and pass each task as a sorted stream.
Conversations up to ``LONG_ROWS`` rows and ``LONG_CHARS`` characters are held
whole; longer ones are only named there and go a second way: a window spread
over (conversation, role, text) tells duplicates, one stream decides with a few
bytes a row, and another meets its audit first and applies it row by row.  The
hash of a conversation is one sequential value, so its rows do pass one task,
but never its memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from campfin.llm.common import SPACES
from campfin.llm.components import stored

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
#: Rows a block; a block's integers have 9 bits a row.
BLOCK = 128
LONG_ROWS, LONG_CHARS = 50_000, 8_000_000

#: Role states: start, after system, after user, after assistant.
_AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_WANTED = ("u", "u", "a", "u")
_NAMES = {"u": "user", "a": "assistant"}
_DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
_LETTER = "\0DIKR"
_ENDS = {0: "", 1: "II", 2: "I", 3: ""}
_FORCED, _TRUNCATED, _INITIALS = 8, 4, "sua"


def _field(letters: str) -> int:
    return sum(_DIGIT[x] << 3 * (2 - i) for i, x in enumerate(letters))


def _spelt(field: int) -> str:
    return "".join(_LETTER[field >> k & 7] for k in (6, 3, 0) if field >> k & 7)


def _edges(code: int) -> list[tuple[int, int, int, int]]:
    """(from, to, cost, field) of a row's edges, the least between two states."""
    best: dict[tuple[int, int], tuple[int, int]] = {}
    cut = CUT if code & _TRUNCATED else 0
    for begin in range(4):
        s, cost = begin, 0
        for n in range(3):
            found = [("D", s, DELETE)]
            if code != _FORCED:
                found.append(("R", _AFTER[s, _WANTED[s]], REROLE + cut))
                kept = _AFTER.get((s, _INITIALS[code & 3])) if code & 3 < 3 else None
                if kept is not None:
                    found.append(("K", kept, KEEP + cut))
            for letter, end, c in found:
                w = (cost + c, _field("I" * n + letter))
                best[begin, end] = min(best.get((begin, end), w), w)
            s, cost = _AFTER[s, _WANTED[s]], cost + INSERT
    return [(a, b, *w) for (a, b), w in best.items()]


_EDGES = {code: _edges(code) for code in (*range(8), _FORCED)}


def cheapest(codes: bytes, block: int = BLOCK) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits of rows given by their codes."""
    ends = [(INSERT * len(_ENDS[s]), len(_ENDS[s])) for s in range(4)]  # cost, rank of what follows
    blocks: list[list[int | None]] = []
    starts = list(range(0, len(codes), block))
    for at in reversed(starts):
        rows = codes[at:at + block]
        width = 9 * len(rows) + 2
        now: list[int | None] = [None if e is None else e[0] << width | e[1] for e in ends]
        for k in range(len(rows) - 1, -1, -1):
            shift = 9 * (len(rows) - 1 - k) + 2
            before: list[int | None] = [None] * 4
            for a, b, cost, field in _EDGES[rows[k]]:
                if now[b] is not None:
                    w = now[b] + (cost << width) + (field << shift)
                    if before[a] is None or w < before[a]:
                        before[a] = w
            now = before
        low = (1 << width) - 1
        order = {x: i for i, x in enumerate(sorted({w & low for w in now if w is not None}))}
        ends = [None if w is None else (w >> width, order[w & low]) for w in now]
        blocks.append([None if w is None else w & low for w in now])
    audit, s = [], 0
    for at, now in zip(starts, reversed(blocks)):
        rows = codes[at:at + block]
        path = now[s]
        for k, code in enumerate(rows):
            letters = _spelt(path >> 9 * (len(rows) - 1 - k) + 2 & 511)
            audit.append(letters)
            for x in letters:
                if x in "IR":
                    s = _AFTER[s, _WANTED[s]]
                elif x == "K":
                    s = _AFTER[s, _INITIALS[code & 3]]
    return ends[0][0], "".join(audit) + _ENDS[s]


def applied(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of an audit's edits met with the rows in order; a
    deleted row comes as it was."""
    s = 0
    for x in audit:
        if x == "I":
            role, text = _NAMES[_WANTED[s]], ""
        else:
            role, text = next(rows)
            role = _NAMES[_WANTED[s]] if x == "R" else role
        if x != "D":
            s = _AFTER[s, role[0]]
        yield x, role, text


def _digest(edits: Iterator[tuple[str, str, str]]) -> str:
    h, first = hashlib.sha256(), True
    for x, role, text in edits:
        if x != "D":
            h.update(("" if first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            first = False
    return h.hexdigest()


class _Conversation:
    """What is known of one conversation while its rows pass in order."""

    def __init__(self, key, hold: bool):
        self.key, self.hold, self.long = key, hold, False
        self.codes, self.rows, self.seen, self.chars = bytearray(), [], set(), 0
        self.first = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None

    def add(self, turn, role: str, text: str, count: int, again: bool | None, most: tuple[int, int]) -> None:
        if self.long or count < 1:
            return
        if turn is not None and (self.turns == 0 or turn != self.last):
            self.turns, self.last = self.turns + 1, turn
            self.first = turn if self.first is None else self.first
        body = text.strip(SPACES)
        initial = role[:1]
        for k in range(count):
            if self.before is not None and self.before + initial not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = initial
            if again is None:
                known = k > 0 or (role, text) in self.seen
            else:
                known = k > 0 or again
            if not body:
                self.blank += 1
                code = _FORCED
            elif known:
                self.duplicate += 1
                code = _FORCED
            else:
                code = _INITIALS.find(initial) if initial else 3
                code = 3 if code < 0 else code
                if body[-1] not in ".!?":
                    self.truncated += 1
                    code |= _TRUNCATED
            self.codes.append(code)
            if self.hold:
                self.rows.append((role, text))
                self.chars += len(text)
        if self.hold:
            self.seen.add((role, text))
            if len(self.codes) > most[0] or self.chars > most[1]:
                self.long, self.codes, self.rows, self.seen = True, bytearray(), [], set()

    def result(self) -> tuple:
        if self.long:
            return (self.key, *[None] * 8)
        cost, audit = cheapest(bytes(self.codes))
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        sha = _digest(applied(audit, iter(self.rows))) if self.hold else None
        return (self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, sha)


_RESULT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")
_TYPES = [pa.int64()] * 6 + [pa.string()] * 2
_NAMES_OUT = ["_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _decide(rows: DataFrame, hold: bool, most: tuple[int, int]) -> DataFrame:
    """One row per conversation of (_id, _turn, _role, _text, _n[, _again]);
    of a long one only its id where ``hold``."""
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done, of = None, [], None

        def out():
            cols = list(zip(*done))
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], of)] + [pa.array(c, t) for c, t in zip(cols[1:], _TYPES)], _NAMES_OUT)

        for batch in batches:
            of = batch.schema.field(0).type
            for at in range(0, batch.num_rows, 2000):
                for key, turn, role, text, count, again in zip(
                        *[c.to_pylist() for c in batch.slice(at, 2000).columns]):
                    if now is None or key != now.key:
                        if now is not None:
                            done.append(now.result())
                        now = _Conversation(key, hold)
                    now.add(turn, role, text, count, again, most)
                if len(done) > 1000:
                    yield out()
        if now is not None:
            done.append(now.result())
        if done:
            yield out()

    again = F.col("_again") if "_again" in rows.columns else F.lit(None).cast("boolean")
    ready = (rows.select("_id", "_turn", "_role", "_text", "_n", again.alias("_again"))
             .repartition("_id").sortWithinPartitions("_id", "_turn", "_role", "_text"))
    return ready.mapInArrow(run, f"_id {kind}, {_RESULT}")


def _meet(rows: DataFrame, audits: DataFrame, whole: bool) -> DataFrame:
    """Apply audits (_id, audit) to the rows in order: the digest of every
    conversation, or with ``whole`` all its edits (_id, pos, edit, role, text)."""
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: list = [None]

        def stream():
            for batch in batches:
                of[0] = batch.schema.field(0).type
                for at in range(0, batch.num_rows, 2000):
                    yield from zip(*[c.to_pylist() for c in batch.slice(at, 2000).columns])

        rest = stream()
        head = next(rest, None)
        while head is not None:
            key, audit, after = head[0], head[2] or "", [None]

            def turns():
                for r in rest:
                    if r[1] == 0:
                        after[0] = r
                        return
                    for _ in range(r[5]):
                        yield r[3], r[4]

            mine = turns()
            edits = applied(audit, mine)
            if whole:
                some: list[tuple] = []
                for pos, e in enumerate(edits):
                    some.append((pos, *e))
                    if len(some) == 2000:
                        yield table_of(key, some, of[0])
                        some = []
                if some:
                    yield table_of(key, some, of[0])
            else:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key], of[0]), pa.array([_digest(edits)])], ["_id", "sha"])
            for _ in mine:  # nothing is left but the next conversation's audit
                pass
            head = after[0]

    def table_of(key, some, of):
        pos, edit, role, text = zip(*some)
        return pa.RecordBatch.from_arrays(
            [pa.array([key] * len(some), of), pa.array(pos, pa.int64()), pa.array(edit), pa.array(role),
             pa.array(text)], ["_id", "pos", "edit", "role", "text"])

    none = F.lit(None).cast("string")
    heads = audits.select("_id", F.lit(0).alias("_k"), F.col("audit").alias("_audit"),
                          F.lit(None).cast(rows.schema["_turn"].dataType).alias("_turn"),
                          none.alias("_role"), none.alias("_text"), F.lit(1).alias("_n"))
    lines = rows.select("_id", F.lit(1).alias("_k"), none.alias("_audit"), "_turn", "_role", "_text", "_n")
    ready = (heads.unionByName(lines).repartition("_id")
             .sortWithinPartitions("_id", "_k", "_turn", "_role", "_text")
             .select("_id", "_k", "_audit", "_role", "_text", "_n"))
    out = "_id {}, pos long, edit string, role string, text string" if whole else "_id {}, sha string"
    return ready.mapInArrow(run, out.format(kind))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _rows(turns: DataFrame, conv: str, turn: str, role: str, text: str, count: str | None) -> DataFrame:
    return turns.select(
        F.col(conv).alias("_id"), F.col(turn).alias("_turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("_role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("_text"),
        (F.coalesce(F.col(count).cast("int"), F.lit(1)) if count else F.lit(1)).alias("_n"))


def judge_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                        role_col: str = "role", text_col: str = "text", count_col: str | None = None,
                        long_rows: int = LONG_ROWS, long_chars: int = LONG_CHARS) -> DataFrame:
    """One row per conversation: id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256.

    ``count_col`` (optional) says how many adjacent copies a row stands for;
    with 0 it only names its conversation.  A null role or text reads as one
    space; null turns come first and count for no gap; null conversation ids
    are one conversation.  Rows of equal turn come in the order of role and
    text.  A role without initial (empty) can't be kept.  Repeated rows are
    duplicates; very long conversations and texts go the second way with equal
    results; an empty table gives no rows; other columns are not read.
    """
    rows = _rows(turns, conv_col, turn_col, role_col, text_col, count_col)
    done = stored(_decide(rows, True, (long_rows, long_chars)), "conversations")
    long = done.where("cost is null").select(F.col("_id").alias("_l"))
    if not long.isEmpty():
        mine = rows.join(long, _same("_id", "_l"), "left_semi").where("_n > 0")
        order = Window.partitionBy("_id", "_role", "_text").orderBy(F.col("_turn").asc_nulls_first())
        mine = mine.withColumn("_again", F.row_number().over(order) > 1)
        decided = stored(_decide(mine, False, (0, 0)), "conversations").drop("repaired_sha256")
        sha = _meet(mine, decided, False).withColumnRenamed("_id", "_h")
        done = done.where("cost is not null").unionByName(
            decided.join(sha, _same("_id", "_h")).drop("_h").withColumnRenamed("sha", "repaired_sha256"))
    return done.withColumnRenamed("_id", conv_col)


def repair_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", count_col: str | None = None
                         ) -> DataFrame:
    """The repaired turns: id, pos (from 0, in the audit), edit (K, R or I),
    role, text; conversations without any turn left give no rows."""
    rows = _rows(turns, conv_col, turn_col, role_col, text_col, count_col)
    audits = judge_conversations(turns, conv_col, turn_col, role_col, text_col, count_col)
    edits = _meet(rows.where("_n > 0"), audits.select(F.col(conv_col).alias("_id"), "audit"), True)
    return edits.where("edit != 'D'").withColumnRenamed("_id", conv_col)


def damage(turns: DataFrame) -> DataFrame:
    """The contract's damage by crc32 of ``conv_id:turn`` (nulls: one space):
    (conv_id, turn, role, text, copies); a dropped row has no copies."""
    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    k = F.pmod(F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))), F.lit(20))
    return turns.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"),
                        k.alias("_k")).select(
        "conv_id", "turn", F.when(F.col("_k") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_k") < 2, "").when(F.col("_k") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("_k") == 0, 0).when(F.col("_k") == 3, 2).otherwise(1).alias("copies"))
