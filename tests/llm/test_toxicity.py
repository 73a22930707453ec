import random
import zlib

import numpy as np

from campfin.llm.toxicity import classify, features, fit, score, train


def brute_features(text):
    c = [ord(x) for x in " " + (text or "").lower() + " "]
    out = set()
    for n in (4, 6):
        for i in range(len(c) - n + 1):
            k = 0
            for x in c[i:i + n]:
                k = (k * 0xD6E8FEB86659FD93 + x) % (1 << 64)
            out.add(k * 0x9E3779B97F4A7C15 % (1 << 64) >> 46)
    return out


def plain_fit(rows, toxic, rounds=200, l2=1e-3):
    """The same model from dense matrices: ratios, then Adam on the logistic loss."""
    x = np.zeros((len(rows), 1 << 18))
    for i, r in enumerate(rows):
        x[i, r] = 1
    p, q = x[toxic].sum(0), x[~toxic].sum(0)
    ratio = np.log((p + 1) / (toxic.sum() + 1) * ((~toxic).sum() + 1) / (q + 1))
    on = (p + q >= max(2, len(rows) * 0.01)) & (abs(ratio) >= 1)
    a = np.hstack([x[:, on] * ratio[on], np.ones((len(rows), 1))])
    share = (toxic.sum() + 1) / (len(rows) + 2)
    w = np.append(np.zeros(on.sum()), np.log(share / (1 - share)))
    keep = np.append(np.full(on.sum(), l2), 0)
    m1 = m2 = 0
    for t in range(1, rounds + 1):
        g = a.T @ (1 / (1 + np.exp(-(a @ w))) - toxic) / len(rows) + keep * w
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        w = w - 0.05 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-7 / np.sqrt(1 - 0.99**t))
    out = np.zeros(1 << 18)
    out[on] = w[:-1] * ratio[on]
    return out, w[-1]


def test_fit_equals_a_plain_one():
    docs, labels = corpus(120)
    rows = [features(t) for _, t, *_ in docs]
    toxic = np.array([t == 1 for _, _, t in labels])
    w, b = fit(rows, toxic)
    v, c = plain_fit(rows, toxic)
    assert w.any() and abs(w - v).max() < 1e-6 and abs(b - c) < 1e-6


def test_windows_are_of_characters():
    cyr = "дурак"   # two bytes a letter: four letters are one window, not two
    assert set(features("xx дура yy").tolist()) & set(features("дура").tolist())
    assert len(features(cyr)) == len(brute_features(cyr)) == 4 + 2


def test_features_equal_brute_force():
    for t in [None, "", "a", "Idiot ídiot", "x" * 5000, "the CLOWN " * 30]:
        got = features(t).tolist()
        assert len(got) == len(set(got)) and set(got) == brute_features(t)


def corpus(n=600, seed=4):
    rnd = random.Random(seed)
    w = ["".join(rnd.choice("aeilnorst") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = [rnd.choice(w) for _ in range(rnd.randint(5, 300))]
        toxic = i % 6 == 0
        if toxic:
            words.insert(rnd.randrange(len(words)), rnd.choice(["idiot", "moron", "scum"]))
        docs.append((i, " ".join(words), "en", 0.5))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_quarter_and_score(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, score double")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = classify(d, lab).collect()
    assert len(rows) == len(docs)
    truth = {i: t for i, _, t in labels}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    test = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in test) >= 0.97 * len(test) > 100
    w, b = train(d, lab)
    by = {r["doc_id"]: r["score"] for r in rows}
    for i, t, *_ in docs[:50]:
        z = sum(w[k] for k in brute_features(t)) + b
        assert abs(by[i] - 1 / (1 + np.exp(-z))) < 1e-6


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = corpus(200)
    d = spark.createDataFrame([x[:2] for x in docs], "doc_id long, text string")
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    a, b = (train(d, spark.createDataFrame(x, "doc_id long, quality int, toxic int"))
            for x in (labels, flipped))
    assert a[1] == b[1] and (a[0] == b[0]).all()


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (2, ""), (None, "idiot"), (3, "ab " * 100000), (4, "idiot"), (5, "nice")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in classify(d, none).collect()} == {0.5}
    one = spark.createDataFrame([(4, 1, 1), (5, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert len(classify(d, one).collect()) == 7
    assert classify(d.limit(0), one).count() == 0
    assert score(d, (np.zeros(1 << 18), 0.0)).count() == 7


def test_documents_held_out(spark):
    d = "/root/testdata/sf0.1"
    docs, lab = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r["doc_id"]: r["toxic"] for r in lab.collect()}
    rows = [r for r in classify(docs, lab).collect() if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in rows]) > 0.96


def test_one_class_fits_a_constant():
    w, b = fit([features("a b"), features("c")], np.array([True, True]))
    assert not w.any() and b > 0
