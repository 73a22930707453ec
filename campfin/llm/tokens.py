"""Token counts by prefix dynamic programming (operator 4).

A byte-pair encoding is *the* encoding of a string exactly when each of its
tokens encodes to itself and each two neighbours stay two tokens when their
concatenation is encoded alone.  So the encoding of every prefix of a word
follows from those of shorter prefixes: of the tokens that end at a position
exactly one is compatible with the last token of the prefix before it, and

    count[end] = count[end - len(token)] + 1.

The pieces of a text don't depend on what follows them, so counts at every
prefix of a text are sums of counts at every prefix of its pieces.  The table
(``deltas``: one 16-bit step per character of the normalised text) answers
"how many tokens has a prefix" and "which is the longest prefix within a
budget" without encoding anything again.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from operator import sub

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

# Fixed values of the vocabulary file's format: the file's own pre-tokeniser
# pattern is read from it; the contractions below are that pattern's literals.
CONTRACTIONS = frozenset(("'s", "'t", "'re", "'ve", "'m", "'ll", "'d"))
END = "\n"  # stands for the file's end-of-word mark; no byte is mapped to it
INNER, FINAL = 0, 1  # keys of a trie node beside its letters
CACHE_CHUNKS = 500_000
CACHE_PAIRS = 500_000
#: White space to the normaliser, but not to ``str.split`` or the other way.
_ODD_SPACE = regex.compile(r"[\x1c-\x1f]")
_SPACE = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies:
    printable Latin-1 stands for itself, the others follow from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, nxt = [], 256
    for b in range(256):
        if b in own:
            out.append(chr(b))
        else:
            out.append(chr(nxt))
            nxt += 1
    return out


def newer_letters() -> list[str]:
    """Letters and numbers to the pattern library that Python's Unicode table
    (which is the tokenizer library's) doesn't assign."""
    every = "".join(chr(c) for c in range(0x80, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    return [ch for ch in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(ch) == "Cn"]


def _class_of(library: Tokenizer, ch: str) -> str:
    """A letter, a digit or another character, as the library's own
    pre-tokeniser takes ``ch``."""
    def pieces(s: str) -> int:
        return len(library.pre_tokenizer.pre_tokenize_str(s))

    return "a" if pieces(f"a{ch}a") == 1 else "0" if pieces(ch * 2) == 2 else "\ue000"


class PrefixCounter:
    """Exact token counts at every prefix for a lower-casing word BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        mark = model["end_of_word_suffix"]

        def own(s: str) -> str:
            return s[: -len(mark)] + END if s.endswith(mark) else s

        self.rank = {}
        for r, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank[own(a), own(b)] = r
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.made = {a + b: (r, a, b) for (a, b), r in reversed(self.rank.items())}
        self.pattern = regex.compile(split["pattern"]["Regex"])
        newer = newer_letters()
        self.newer = frozenset(newer)
        # One range tells nearly all texts; only then is the set looked at.
        self.late = re.compile(f"[{min(newer)}-\U0010ffff]") if newer else re.compile("(?!)")
        # What the library itself takes them for, and their small letters there.
        library = Tokenizer.from_file(path)
        self.stand_in = {ord(ch): _class_of(library, ch) for ch in newer}
        self.small = {ord(ch): library.normalizer.normalize_str(ch) for ch in newer}
        specials = [regex.escape(t["content"]) for t in spec["added_tokens"] if t["special"]]
        self.special = regex.compile("|".join(specials)) if specials else None
        self.special_mark = min((t["content"][:2] for t in spec["added_tokens"]), default="")
        self.letters = byte_letters()
        # A token that does not encode to itself never occurs in an encoding.
        self.tokens = [t for t in map(own, model["vocab"]) if self._merge(t) == [t]]
        self.trie: dict = {}
        for k, t in enumerate(self.tokens):
            node = self.trie
            for ch in t.removesuffix(END):
                node = node.setdefault(ch, {})
            node[FINAL if t.endswith(END) else INNER] = k
        self.pair: dict[int, bool] = {}
        self.chunk = _Chunks(self)

    def _merge(self, s: str) -> list[str]:
        """Plain merging, for the short strings of pair checks."""
        parts = list(s[:-2]) + [s[-2:]] if s.endswith(END) and len(s) > 1 else list(s)
        while len(parts) > 1:
            best = min(((self.rank.get(p, 1 << 60), i) for i, p in
                        enumerate(zip(parts, parts[1:]))))
            if best[0] == 1 << 60:
                break
            a, b = parts[best[1]], parts[best[1] + 1]
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and parts[i] == a and parts[i + 1] == b:
                    out.append(a + b)
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def _stay(self, a: int, b: int) -> bool:
        """Whether two neighbouring tokens stay apart: undo, latest merge
        first, the merges that made them, and look for an earlier merge across
        the border (of equal ones the left one comes first)."""
        key, x, y = a << 20 | b, self.tokens[a], self.tokens[b]
        rank, made, limit = self.rank, self.made, 1 << 60
        while True:
            if rank.get((x, y), limit) < limit:
                ok = False
                break
            rx, ry = made.get(x), made.get(y)
            if rx is not None and (ry is None or rx[0] > ry[0]):
                limit, x = rx[0], rx[2]
            elif ry is not None:
                limit, y = ry[0] + 1, ry[1]
            else:
                ok = True
                break
        if len(self.pair) >= CACHE_PAIRS:
            self.pair.clear()
        self.pair[key] = ok
        return ok

    def word_prefixes(self, word: str) -> list[int]:
        """Counts for word[:1], word[:2], ... of one piece, each prefix taken
        as a whole text of its own.  Every position is reached by exactly one
        token that stays apart from the last one before it."""
        if word.isascii() and word.isprintable():
            s, ends = word, None
        else:
            parts = ["".join([self.letters[b] for b in ch.encode("utf-8", "replace")])
                     for ch in word]
            s, ends = "".join(parts), []
            for part in parts:
                ends.append(len(part) + (ends[-1] if ends else 0))
        n = len(s)
        count, last, final = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        pair, trie = self.pair, self.trie
        for i in range(n):
            node, j, c, before = trie, i, count[i] + 1, last[i] << 20
            while j < n:
                node = node.get(s[j])
                if node is None:
                    break
                j += 1
                t = node.get(INNER)
                if t is not None and not count[j]:
                    ok = i == 0 or pair.get(before | t)
                    if ok is None:
                        ok = self._stay(last[i], t)
                    if ok:
                        count[j], last[j] = c, t
                t = node.get(FINAL)
                if t is not None and not final[j]:
                    ok = i == 0 or pair.get(before | t)
                    if ok is None:
                        ok = self._stay(last[i], t)
                    if ok:
                        final[j] = c
        return final[1:] if ends is None else [final[e] for e in ends]

    def _has_newer(self, text: str) -> bool:
        return self.late.search(text) is not None and not self.newer.isdisjoint(set(text))

    def pieces(self, chunk: str) -> list[str]:
        """The pre-tokeniser's pieces; for characters that the two libraries'
        Unicode tables may tell apart stands one of the class they have there."""
        if chunk.isascii() or not self._has_newer(chunk):
            return self.pattern.findall(chunk)
        return [chunk[m.start():m.end()] for m in self.pattern.finditer(chunk.translate(self.stand_in))]

    def chunk_deltas(self, chunk: str) -> bytes:
        """Steps of the count along a run without white space.  A piece's
        steps start from nothing, so those of a chunk are its pieces' joined."""
        if not chunk.isalpha():
            pieces = self.pieces(chunk)
            if len(pieces) > 1:
                return b"".join(map(self.chunk.__getitem__, pieces))
            if chunk in CONTRACTIONS:
                counts = [sum(self.word_prefixes(p)[-1] for p in self.pieces(chunk[:k]))
                          for k in range(1, len(chunk) + 1)]
                return _steps(counts)
        return _steps(self.word_prefixes(chunk))

    def normalise(self, text: str) -> str:
        """NFC, white space runs to one space, lower case by character."""
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return self._small(_SPACE.sub(" ", text))

    def _small(self, text: str) -> str:
        text = text.replace("Σ", "σ").lower()
        if not text.isascii() and self._has_newer(text):
            text = text.translate(self.small)
        return text

    def _plain_deltas(self, text: str) -> bytes:
        if not text:
            return b""
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        low = self._small(text)
        chunks = low.split() if not _ODD_SPACE.search(low) else [c for c in _SPACE.split(low) if c]
        lead = b"\0\0" if _SPACE.match(low) else b""
        if not chunks:
            return lead
        tail = b"\0\0" if _SPACE.match(low[-1]) else b""
        return lead + b"\0\0".join(map(self.chunk.__getitem__, chunks)) + tail

    def deltas(self, text: str | None) -> bytes:
        """One little-endian 16-bit step per character of the normalised text.
        A special token's string counts one token at its last character, as
        the library handles it inside texts."""
        text = text or ""
        if len(self.chunk) > CACHE_CHUNKS:
            self.chunk.clear()
        if self.special is None or self.special_mark not in text:
            return self._plain_deltas(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [self._plain_deltas(text[at:m.start()]),
                    b"\0\0" * (len(m.group()) - 1), b"\1\0"]
            at = m.end()
        return b"".join([*out, self._plain_deltas(text[at:])])


def _steps(counts: list[int]) -> bytes:
    steps = array("h", [counts[0], *map(sub, counts[1:], counts)])
    if sys.byteorder == "big":
        steps.byteswap()
    return steps.tobytes()


class _Chunks(dict):
    def __init__(self, counter: PrefixCounter):
        super().__init__()
        self.counter = counter

    def __missing__(self, chunk: str) -> bytes:
        got = self.counter.chunk_deltas(chunk)
        if len(chunk) <= 64:
            self[chunk] = got
        return got


def tokens_at(deltas: bytes, n_chars: int) -> int:
    """Tokens of the first ``n_chars`` characters of the normalised text."""
    return int(np.frombuffer(deltas, "<i2", min(n_chars, len(deltas) // 2)).sum(dtype=np.int64))


def longest_prefix(deltas: bytes, budget: int) -> int:
    """Characters of the longest prefix with at most ``budget`` tokens."""
    fits = np.flatnonzero(np.cumsum(np.frombuffer(deltas, "<i2"), dtype=np.int64) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def prefix_tables(docs: DataFrame, vocab: str, id_col: str = "doc_id",
                  text_col: str = "text", limit: int = 2048, keep_deltas: bool = True) -> DataFrame:
    """One row per document: id, n_bytes (UTF-8), n_tokens, over_limit,
    limit_chars (the longest prefix of the normalised text within ``limit``
    tokens; all of it when not over) and, with ``keep_deltas``, the table.

    Null and empty texts have no bytes and no tokens; repeated rows give
    repeated results; an empty table gives none; other columns aren't read.
    One narrow pass, no shuffle; a worker keeps a bounded cache of chunks.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(vocab)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                tables = [c.deltas(t) for t in part.column(1).to_pylist()]
                totals = [int(np.frombuffer(d, "<i2").sum(dtype=np.int64)) for d in tables]
                chars = [longest_prefix(d, limit) if n > limit else len(d) // 2
                         for d, n in zip(tables, totals)]
                cols = [part.column(0), part.column(2), pa.array(totals, pa.int64()),
                        pa.array([n > limit for n in totals], pa.bool_()),
                        pa.array(chars, pa.int64())]
                names = ["_id", "n_bytes", "n_tokens", "over_limit", "limit_chars"]
                if keep_deltas:
                    cols.append(pa.array(tables, pa.binary()))
                    names.append("deltas")
                yield pa.RecordBatch.from_arrays(cols, names)

    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
                      F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("_bytes"))
    kind = src.schema["_id"].dataType.simpleString()
    out = src.mapInArrow(run, f"_id {kind}, n_bytes long, n_tokens long, over_limit boolean, "
                              "limit_chars long" + ", deltas binary" * keep_deltas)
    return out.withColumnRenamed("_id", id_col)
