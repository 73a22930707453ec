import random

from campfin.llm import components as m
from campfin.llm.components import components


def brute(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return sorted((x, find(x)) for x in list(root))


def graphs():
    rnd = random.Random(2)
    yield [(i, i + 1) for i in range(300)] + [(900, 901)]                    # a long path
    order = list(range(200))
    rnd.shuffle(order)
    yield list(zip(order, order[1:]))                                        # a path in random order
    yield [(0, i) for i in range(1, 500)] + [(1000, i) for i in range(499, 600)]   # two stars that touch
    yield [(i, rnd.randrange(i)) for i in range(1, 300)]                     # a tree
    yield [(rnd.randrange(400), rnd.randrange(400)) for _ in range(250)]     # loops and repeats among them
    yield [(5, 5)]
    yield [(2, 1), (1, 2), (2, 1)]


def test_components_equal_union_find(spark):
    for edges in graphs():
        df = spark.createDataFrame([(a, b) for a, b in edges], "a long, b long")
        got = sorted(map(tuple, components(df).collect()))
        assert got == brute(edges)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stars_take_no_round(spark, monkeypatch):
    monkeypatch.setattr(m, "_towards", None)
    df = spark.createDataFrame([(1, i) for i in range(2, 50)], "a long, b long")
    assert components(df).where("root != 1").count() == 0
