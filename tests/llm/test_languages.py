import zlib

import numpy as np

from logloom.llm import langmix, queries
from logloom.llm.common import held_out, table

SF = "/root/testdata/sf0.001"


def test_held_out_is_crc32_of_the_id(spark):
    rows = spark.range(200).select("id", held_out("id").alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_held_out_accuracy_and_contract(spark):
    found = queries.op1_language(spark, "/root/testdata/sf0.01")
    assert found.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    rows = found.join(table(spark, "/root/testdata/sf0.01", "documents"), "doc_id").filter("held_out").collect()
    assert len(rows) > 150
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_counts_equal_plain_python_also_in_pieces(monkeypatch):
    def plain(text):
        import re

        seen = re.sub(rb"[^a-z\x80-\xff]+", b" ", b" " + text.lower() + b" ")
        return sorted(seen[i : i + 3] for i in range(len(seen) - 2))

    text = "Été à la mer,  en A\tune\nfois!".encode()
    counts = dict(enumerate(next(langmix.profiles([text]))[2]))
    want = np.zeros(langmix.BUCKETS, int)
    for gram in plain(text):
        want[int.from_bytes(gram, "little") * 2654435761 % 2**32 >> 18] += 1
    assert [counts[i] for i in np.flatnonzero(want)] == want[want > 0].tolist() and sum(counts.values()) == want.sum()
    # Texts in one block, and pieces of a long one, count as if they stood alone.
    two = next(langmix.profiles([text, None, text]))[2].reshape(3, -1)
    assert (two[0] == want).all() and (two[2] == want).all() and not two[1].any()
    monkeypatch.setattr(langmix, "_SIZE", 8)
    for text in (text, b"a" * 8, b" " * 30, b"", b"seven  -", b"no space at any cut of it".replace(b" ", b"x"), b"12345678 a"):
        monkeypatch.setattr(langmix, "_SIZE", 1 << 20)
        whole = langmix._trigrams([text], 1)
        for size in (1, 2, 3, 7, 8):
            monkeypatch.setattr(langmix, "_SIZE", size)
            assert (next(langmix.profiles([text]))[2] == whole).all(), (text, size)


def test_texts_of_three_mebibytes_count_as_in_one_piece():
    text = ("Où est, où était la maison? " * 120_000).encode()
    assert len(text) > 3 << 20
    assert (next(langmix.profiles([text]))[2] == langmix._trigrams([text], 1)).all()


def test_mixture_equals_plain_expectation_maximisation():
    random = np.random.default_rng(0)
    p = random.dirichlet(np.ones(langmix.BUCKETS) * 0.01, 3).T + 1e-9
    p /= p.sum(0)
    counts = random.multinomial(600, p[:, 0]) + random.multinomial(400, p[:, 2])
    single = random.multinomial(50, p[:, 1])
    theta = langmix.mixtures(np.concatenate([counts, single, 0 * single]), 3, np.log(p), steps=200)
    share = np.array([0.5, 0, 0.5])
    for _ in range(200):
        weighted = p * share
        share = (counts[:, None] * weighted / weighted.sum(1, keepdims=True)).sum(0) / counts.sum()
    assert np.allclose(theta[0], share, atol=1e-3) and abs(share[0] - 0.6) < 0.05
    assert theta[1].tolist() == [0, 1, 0]
    assert not theta[2].any()


def test_odd_rows(spark, odd, none):
    model = langmix.fit(odd)
    assert model.languages == ["de", "en"]
    rows = {(r.doc_id, r.lang_pred, r.score) for r in langmix.predict(odd, model).collect()}
    assert langmix.predict(odd, model).count() == odd.count()
    assert {i for i, lang, score in rows if lang == "und"} == {1, 2, 3, 8} and all(s == 0 for i, lang, s in rows if lang == "und")
    empty = langmix.fit(none)
    assert empty.languages == [] and langmix.predict(none, empty).count() == 0
    assert {r.lang_pred for r in langmix.predict(odd, empty).collect()} == {"und"}
