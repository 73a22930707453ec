import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from campfin.llm.tokens import counter, longest_prefix, newer_letters, prefix_tables, tokens_at

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def n_lib(lib, text):
    return len(lib.encode(text, add_special_tokens=False).ids)


TEXTS = [
    "", " ", "\n\t x", "Hello, it's they're we'll 'tis don't!'s ''re '", "áé İstanbul",
    "ΣΣ οδός ΟΔΟΣ", "x\x1cy\x1f z\x85q r　s",
    "<|endoftext|>", "a<|endoftext|>b <|startoftext|><|x", "1234567 12,50 ٣", "!" * 70 + "?" * 9,
    "word " * 50, "ab" * 300, "\U0001f600\U0001f601 你好", "www.example.com/foo?bar=1&baz=üß",
]


def test_texts_equal_the_library(lib):
    c = counter(PATH)
    rnd = random.Random(5)
    alphabet = "aabcdeeinorst'.,-! \néü0123"
    texts = TEXTS + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 80)))
                     for _ in range(2000)]
    for t in texts:
        d = c.deltas(t)
        assert tokens_at(d, len(d)) == n_lib(lib, t), t


def test_letters_newer_than_the_library(lib):
    c = counter(PATH)
    newer = newer_letters()
    for ch in newer:
        for t in (f"a{ch}b {ch}{ch}1", f"'s{ch}"):
            d = c.deltas(t)
            assert tokens_at(d, len(d)) == n_lib(lib, t), hex(ord(ch))
    assert len(newer) > 100


def test_every_prefix_equals_the_library(lib):
    c = counter(PATH)
    for t in [x for x in TEXTS if "<|" not in x]:
        norm, d = c.normalise(t), c.deltas(t)
        assert len(d) == 2 * len(norm)
        for k in range(len(norm) + 1):
            assert tokens_at(d, k) == n_lib(lib, norm[:k]), (t, k)


def test_pair_check_equals_plain_merging():
    c = counter(PATH)
    rnd = random.Random(1)
    n = len(c.tokens)
    starts = [i for i in range(n) if not c.tokens[i].endswith("\n")]
    for _ in range(20000):
        a, b = rnd.choice(starts), rnd.randrange(n)
        x, y = c.tokens[a], c.tokens[b]
        assert c._stay(a, b) == (c._merge(x + y) == [x, y]), (x, y)


def test_longest_prefix(lib):
    c = counter(PATH)
    t = "the transformation of representation is it's unbelievable" * 3
    d = c.deltas(t)
    for budget in range(0, 30):
        brute = max(k for k in range(len(t) + 1) if n_lib(lib, t[:k]) <= budget)
        assert longest_prefix(d, budget) == brute


def test_operator(spark, lib):
    rows = [(i, t, "a", 1) for i, t in enumerate(TEXTS)] + [(None, "the", "b", 2), (3, None, "c", 3),
                                                            (3, "x " * 30000, "d", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, n_bytes int")
    got = sorted((tuple(r) for r in prefix_tables(df, PATH, keep_deltas=False).collect()), key=str)
    want = []
    for i, t, *_ in rows:
        n = n_lib(lib, t or "")
        want.append((i, len((t or "").encode()), n, n > 2048))
    assert [g[:4] for g in got] == sorted(want, key=str)
    assert prefix_tables(df.limit(0), PATH).count() == 0


def test_documents_equal_the_library(spark, lib):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in prefix_tables(docs, PATH).collect():
        assert r["n_tokens"] == n_lib(lib, texts[r["doc_id"]])
        assert tokens_at(bytes(r["deltas"]), 1 << 40) == r["n_tokens"]
