import random

import numpy as np
import pytest

from campfin.llm import similar
from campfin.llm.common import py_words
from campfin.llm.components import components
from campfin.llm.similar import (one_per_class, pack_set, prefix_size, similar_classes, unpack_set)


def brute_sets(text, k=4):
    w = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in py_words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute(docs, percent=85):
    """Row by row: (id, n, smallest id reachable)."""
    sets = [brute_sets(t) for _, t in docs]
    par = list(range(len(docs)))

    def root(x):
        while par[x] != x:
            par[x] = par[par[x]]
            x = par[x]
        return x
    by = {}
    for i, s in enumerate(sets):
        if s:
            for t in s:
                by.setdefault(t, []).append(i)
    seen = set()
    for group in by.values():
        for x in range(len(group)):
            for y in range(x + 1, len(group)):
                p = (group[x], group[y])
                if p in seen:
                    continue
                seen.add(p)
                o = len(sets[p[0]] & sets[p[1]])
                if 100 * o >= percent * len(sets[p[0]] | sets[p[1]]):
                    par[root(p[0])] = root(p[1])
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(docs)]


def corpus(seed=3, clusters=12):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcde") for _ in range(rnd.randint(2, 6)))
    passage = " ".join(word() for _ in range(40))
    docs = []
    for _ in range(clusters):
        base = [word() for _ in range(rnd.randint(3, 160))]
        for _ in range(rnd.choice([1, 2, 5, 30])):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 3])):
                w[rnd.randrange(len(w))] = word()
            docs.append(" ".join(w))
    docs += [passage + " " + " ".join(word() for _ in range(rnd.randint(20, 200))) for _ in range(60)]
    rnd.shuffle(docs)
    return list(enumerate(docs))


def key(t):
    return tuple(map(str, t))


@pytest.mark.parametrize("group", [1, 16])
def test_equals_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(similar, "GROUP", group)
    monkeypatch.setattr(similar, "LOCAL", 2)
    docs = corpus() + [(500, None), (501, ""), (502, " \t\n"), (503, "One two"), (504, "one TWO"), (505, "two one"),
                       (506, "a b c d"), (506, "q r s t u"), (507, "q r s t u"), (None, "a b c d"), (None, "z z z z z z"),
                       (508, "É é x y"), (509, "é é x y"), (510, "r1 " * 40000), (511, "r1 " * 5)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, node string, n int")
    got = sorted((tuple(r) for r in similar_classes(df).collect()), key=key)
    assert got == sorted(brute(docs), key=key)
    kept = one_per_class(df)
    assert kept.columns == df.columns
    want = {c for d, n, c in brute(docs) if n}
    rows = [r for r in kept.collect() if brute_sets(r["text"])]
    assert sorted(str(r["doc_id"]) for r in rows) == sorted([str(c) for c in want - {506}] + ["506", "506"])
    assert len([r for r in kept.collect() if not brute_sets(r["text"])]) == 3


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert similar_classes(df).count() == 0 and one_per_class(df).count() == 0


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(tuple(r) for r in similar_classes(docs).collect()) == sorted(want)
    assert sum(d != c for d, _, c in want) > 20


def test_components(spark):
    rnd = random.Random(0)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1060)]
    edges += [(2000, x) for x in range(2001, 2050)] + [(5, 5)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    par = {}
    for a, b in edges:
        par.setdefault(a, a), par.setdefault(b, b)
    change = True
    while change:
        change = False
        for a, b in edges:
            m = min(par[a], par[b])
            if par[a] != m or par[b] != m:
                par[a] = par[b] = m
                change = True
    loops = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert got == {k: v for k, v in par.items() if k not in loops}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_helpers():
    s = np.sort(np.random.default_rng(1).integers(0, 1 << 48, 500))
    assert (unpack_set(pack_set(s)) == s).all()
    for n in range(1, 300):
        least = min(o for o in range(n + 1) if 100 * o >= 85 * n)
        assert prefix_size(n, 85) == n - least + 1
