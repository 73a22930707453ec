import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from campfin.llm.packing import binary_pieces, encoder, pack, write_buckets

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


TEXTS = ["", " ", None, "Hello  world\n\n it's 12 3", "a<|endoftext|>b", "é ü 你好 \U0001f600", "x" * 5000,
         " " * 5000 + "y", "\t\n " * 900, "word " * 3000, "\x1c\x85 　q", "<|endoftext|>", "'ll 're"]


def test_ids_equal_the_library(lib):
    enc, rnd = encoder(PATH), random.Random(3)
    alphabet = "aaeeiou tnsr\n'.,<|>é　ß01 "
    texts = TEXTS + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 200)))
                     for _ in range(1500)]
    for t in texts:
        assert enc.ids(t).tolist() == lib.encode(t or "", add_special_tokens=False).ids, t


def test_binary_pieces():
    for n in range(0, 5000, 7):
        got = binary_pieces(n, 1024)
        assert sum(size for _, size in got) == n
        assert [s for s, _ in got] == [sum(z for _, z in got[:k]) for k in range(len(got))]
        assert all(z & (z - 1) == 0 and z <= 1024 for _, z in got)


def check(rows, texts, lib):
    seqs = set()
    by_doc = {}
    for r in rows:
        assert r["offset"] == 0 and r["length"] & (r["length"] - 1) == 0 and r["length"] <= 1024
        assert r["sequence_id"] not in seqs
        seqs.add(r["sequence_id"])
        ids = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(ids) == r["length"] and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        by_doc.setdefault(r["doc_id"], []).append((r["start"], ids.tolist(), r["doc_tokens"]))
    assert set(by_doc) == set(texts)
    for d, parts in by_doc.items():
        want = [*lib.encode(texts[d] or "", add_special_tokens=False).ids, 0]
        got = []
        for start, ids, total in sorted(parts):
            assert start == len(got) and total == len(want)
            got += ids
        assert got == want


def test_round_trip_of_edge_cases(spark, lib, tmp_path):
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in enumerate(TEXTS)],
                               "doc_id long, text string, ids string, length int")
    packed = pack(df, PATH)
    check(packed.collect(), dict(enumerate(TEXTS)), lib)
    write_buckets(packed, str(tmp_path / "seq"))
    assert spark.read.parquet(str(tmp_path / "seq")).count() == packed.count()
    assert pack(df.limit(0), PATH).count() == 0


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    rows = pack(df, PATH, keep_ids=False).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 6


def test_round_trip_of_documents(spark, lib):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(pack(docs, PATH).collect(), {r["doc_id"]: r["text"] for r in docs.collect()}, lib)
