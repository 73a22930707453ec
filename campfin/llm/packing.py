"""Packing by power-of-two decomposition (operator 8).

A document's token ids are cut into pieces whose lengths are powers of two:
as many of the longest length as fit, then the binary digits of what is left.
Pieces of one length form a bucket, and each piece is a sequence of its own:
no sequence crosses documents, none needs padding, and a training step draws
its sequences from one bucket.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from campfin.llm.tokens import byte_letters

# Fixed value: the byte-level pre-tokeniser's pattern, as published.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Longer texts are left to the tokenizers library, whose merging and white
#: space rules stay fast on any run of characters.
LONG_RUN = 2000


class ByteEncoder:
    """Ids of a byte-level BPE file as the tokenizers library gives them.

    In such a file a merged token's id orders its merge, so the same table
    serves the faster encoder.  Texts with very long runs (of letters, of
    white space, ...) go to the library itself.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = {c: b for b, c in enumerate(byte_letters())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items()
                 if t not in special}
        self.fast = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_PATTERN,
                                      mergeable_ranks=ranks, special_tokens=special)
        self.special = [s for s in special]
        self.library = Tokenizer.from_file(path)

    def ids(self, text: str | None) -> np.ndarray:
        text = text or ""
        if len(text) > LONG_RUN and _longest_run(text) > LONG_RUN:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        allowed = "all" if any(s in text for s in self.special) else set()
        return self.fast.encode_to_numpy(text, allowed_special=allowed, disallowed_special=())


def _longest_run(text: str) -> int:
    """Bytes of the longest run of white space or of anything else."""
    b = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    space = (b == 32) | ((b >= 9) & (b <= 13))
    edges = np.flatnonzero(np.diff(space))
    return int(np.diff(np.concatenate(([-1], edges, [len(b) - 1]))).max())


_ENCODERS: dict[str, ByteEncoder] = {}


def encoder(path: str) -> ByteEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteEncoder(path)
    return _ENCODERS[path]


def binary_pieces(n: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of the power-of-two pieces of ``n`` ids, in order."""
    out, at = [], 0
    while n - at >= longest:
        out.append((at, longest))
        at += longest
    while at < n:
        size = 1 << ((n - at).bit_length() - 1)
        out.append((at, size))
        at += size
    return out


def pack(docs: DataFrame, vocab: str, longest: int = 1024, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, with ``keep_ids``, ids (little-endian 32-bit).

    ``longest`` is a power of two.  Each document's ids end with ``end_id``,
    so null and empty texts give one piece of length 1.  A piece is a whole
    sequence (offset 0, no padding); ``length`` is its bucket.  Repeated rows
    are packed each for itself under sequence ids of their own, which follow
    the splits of the table: write the result before they are used as keys.
    An empty table gives no rows; other columns are not read.  One narrow pass, no shuffle:
    a very long document streams out of its own task piece by piece.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                doc, start, size, crc, total, ids = [], [], [], [], [], []
                for k, text in enumerate(part.column(1).to_pylist()):
                    tok = np.append(enc.ids(text), np.uint32(end_id)).astype("<u4")
                    raw = tok.tobytes()
                    for s, n in binary_pieces(len(tok), longest):
                        piece = raw[4 * s:4 * (s + n)]
                        doc.append(k)
                        start.append(s)
                        size.append(n)
                        crc.append(zlib.crc32(piece))
                        total.append(len(tok))
                        if keep_ids:
                            ids.append(piece)
                cols = [part.column(0).take(pa.array(doc, pa.int32())), pa.array(start, pa.int64()),
                        pa.array(size, pa.int64()), pa.array(crc, pa.int64()),
                        pa.array(total, pa.int64())]
                names = ["_id", "start", "length", "ids_crc32", "doc_tokens"]
                if keep_ids:
                    cols.append(pa.array(ids, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = src.schema["_id"].dataType.simpleString()
    out = src.mapInArrow(run, f"_id {kind}, start long, length long, ids_crc32 long, "
                              "doc_tokens long" + ", ids binary" * keep_ids)
    return out.select(
        F.col("_id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        *(["ids"] * keep_ids))


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write the sequences with one folder per length; a trainer reads one
    folder per step."""
    packed.withColumn("bucket", F.col("length")).write.partitionBy("bucket").parquet(path)
