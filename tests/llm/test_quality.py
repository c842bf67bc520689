import numpy as np
from pyspark.sql import functions as F

from logloom.llm import nbsvm, queries
from logloom.llm.common import table


def test_held_out_rows_are_told_apart(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.op3_quality(spark, sf)
    rows = found.filter("held_out").join(table(spark, sf, "labels"), "doc_id").collect()
    good = np.array([r.score for r in rows if r.quality == 1])
    poor = np.array([r.score for r in rows if r.quality == 0])
    assert len(poor) >= 5 and (good[:, None] > poor).mean() > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_indicators_equal_plain_sets(monkeypatch):
    texts = [b"abcab  ab", None, b"", b"x", "zwei zwei zwei é".encode()]

    def plain(t):
        out = set()
        for order in nbsvm.ORDERS:
            for i in range(len(t) - order + 1):
                code = int.from_bytes(t[i : i + order], "little")
                out.add((code * 2654435761 + order * 0x9E3779B1) % 2**32 >> 16)
        words = t.split()
        for level, n in enumerate((2, 3, 5, 9)):
            if any(len(set(words[i : i + n])) == 1 for i in range(len(words) - n + 1)):
                out.add(nbsvm.DIMENSIONS - 1 - level)
        return out

    want = [plain(t or b"") for t in texts]

    def found():
        out = [set() for _ in texts]
        for start, _, places in nbsvm.indicators(texts):
            for p in places:
                out[start + p // nbsvm.DIMENSIONS].add(int(p % nbsvm.DIMENSIONS))
        return out

    assert found() == want
    monkeypatch.setattr(nbsvm, "_ROWS", 1)
    assert found() == want
    long = b"abcdefgh" * 3
    whole = set(next(nbsvm.indicators([long]))[2])
    monkeypatch.setattr(nbsvm, "_SIZE", 8)
    assert set(next(nbsvm.indicators([long]))[2]) == whole


def plain_repeats(text):
    words = text.split()
    return {n for n in (2, 3, 5, 9) if any(len(set(words[i : i + n])) == 1 for i in range(len(words) - n + 1))}


def repeats(places):
    return {n for level, n in enumerate((2, 3, 5, 9)) if nbsvm.DIMENSIONS - 1 - level in places}


def test_repeated_words_across_cuts(monkeypatch):
    random = np.random.default_rng(4)
    for size in (4, 5, 8):
        monkeypatch.setattr(nbsvm, "_SIZE", size)
        for _ in range(300):
            word = [b"a", b"ab", b"aba", b"longer-than-pieces"][random.integers(4)]
            text = b"".join(random.choice([word, b"b", b"ab"], p=[0.8, 0.1, 0.1]) + b" " * random.integers(0, 3) for _ in range(random.integers(1, 14)))
            if len(text) > size:
                assert repeats(set(next(nbsvm.indicators([text]))[2])) == plain_repeats(text), (size, text)


def test_nine_words_around_the_border_of_a_long_text():
    fill = b" ".join(b"%d" % i for i in range(500_000))
    for at in range((1 << 20) - 30, (1 << 20) + 4, 3):
        text = fill[:at] + b" same same same same same same same same same " + fill[at:]
        assert len(text) > 3 << 20 and repeats(set(next(nbsvm.indicators([text]))[2])) == {2, 3, 5, 9}


def test_last_word_does_not_depend_on_the_next_text():
    blocks = [set((places[places // nbsvm.DIMENSIONS == 0])) for _, _, places in nbsvm.indicators([b"one one", b"x"])]
    assert repeats(blocks[0]) == {2}


def test_descent_reaches_the_optimum_of_the_dual():
    random = np.random.default_rng(2)
    index = [np.sort(random.choice(40, 8, replace=False)) for _ in range(60)]
    signs = np.where([3 in i or 7 in i for i in index], 1.0, -1.0)
    ratios = np.ones(nbsvm.DIMENSIONS)
    weights, bias = nbsvm.descend(index, signs, ratios, 1.0, 2000, 0)

    def loss(w, b):
        margin = np.array([w[i].sum() / np.sqrt(8) + b for i in index])
        return 0.5 * (w @ w + b * b) + np.maximum(0, 1 - signs * margin).sum()

    best = loss(weights, bias)
    for _ in range(200):
        assert best <= loss(weights + random.normal(0, 0.02, len(weights)) * (weights != 0), bias + random.normal(0, 0.02)) + 1e-6


def test_odd_rows_and_labels(spark, odd, none):
    labels = spark.createDataFrame([(1, 0), (5, 1), (5, 1), (7, 0), (8, None), (None, 1)], "doc_id long, quality int")
    model = nbsvm.fit(odd, labels)
    rows = nbsvm.score(odd, model, keep=tuple(odd.columns), name="__s").collect()
    assert len(rows) == odd.count() and all(0 <= r["__s"] <= 1 for r in rows) and rows[0].score in ("x", None)
    empty = {r["__s"] for r in rows if not r.text}
    assert len(empty) == 1
    # One class, or nothing to learn from: a constant.
    for some in (labels.filter("quality = 1"), labels.limit(0)):
        constant = {r.score for r in nbsvm.score(odd, nbsvm.fit(odd, some)).collect()}
        assert len(constant) == 1 and 0.4 < constant.pop() < 1
    assert nbsvm.score(none, model).count() == 0


def test_same_rows_same_model(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.format_string("text %s", "id").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    one, two = (nbsvm.fit(docs.repartition(n), labels, sample_rows=100) for n in (2, 5))
    assert (one.weights == two.weights).all() and one[2:] == two[2:]
