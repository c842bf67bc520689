import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from __spark_entry__ import queries
from logloom.llm import ngramlm
from logloom.llm.common import held_out
from logloom.llm.eliasfano import STEPS, EliasFano, Trie

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(_LOWER)) + [None]


class Plain:
    """The same model in dictionaries, without rounding."""

    def __init__(self, texts, discounts=None):
        self.c = [Counter(), Counter(), Counter()]
        for t in texts:
            x = ["begin", *tokens(t)]
            self.c[0].update((w,) for w in x[1:])
            self.c[1].update(zip(x, x[1:]))
            self.c[2].update(zip(x, x[1:], x[2:]))
        self.n, self.v = sum(self.c[0].values()), len(self.c[0])
        self.d = [ngramlm.discount(*(sum(n == k for n in c.values()) for k in (1, 2))) for c in self.c]
        self.d[1:] = discounts or self.d[1:]
        self.total, self.types = Counter(), Counter()
        for c in self.c[1:]:
            for gram, n in c.items():
                self.total[gram[:-1]] += n
                self.types[gram[:-1]] += 1

    def p(self, context, word):
        if not context:
            seen = (self.c[0][(word,)] - self.d[0]) / self.n if self.c[0][(word,)] else 0
            return seen + self.d[0] * self.v / self.n / (self.v + 1) if self.n else 1 / (self.v + 1)
        shorter = self.p(context[1:], word)
        total, k = self.total[context], len(context)
        if not total:
            return shorter
        return max(self.c[k][(*context, word)] - self.d[k], 0) / total + self.d[k] * self.types[context] / total * shorter

    def scores(self, text):
        x = ["begin", *tokens(text)]
        counts = [self.c[0][(w,)] for w in x[1:]]
        base = sum(math.log10((c + 0.5) / (self.n + 0.5 * (self.v + 1))) for c in counts)
        model = sum(math.log10(self.p(tuple(x[max(0, i - 2) : i]), x[i])) for i in range(1, len(x)))
        return len(counts), sum(c > 0 for c in counts), self.n, base, model


def same(row, expected):
    assert (row.n_tokens, row.n_known, row.train_tokens) == expected[:3]
    assert row.base_score == pytest.approx(expected[3], rel=1e-12)
    assert row.score == pytest.approx(expected[4], abs=3 * row.n_tokens / STEPS)


def test_query_equals_plain_model(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    learned = [i for i in texts if zlib.crc32(str(i).encode()) % 5 != 1]
    plain = Plain(texts[i] for i in learned)
    rows = queries()["op12_lm"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.held_out == (r.doc_id not in learned)
        same(r, plain.scores(texts[r.doc_id]))


def test_many_blocks_and_shards_and_first_words_dealt_over_several(spark, monkeypatch):
    monkeypatch.setattr(ngramlm, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(ngramlm, "SHARD_TOKENS", 500)
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    texts = {r.doc_id: r.text for r in df.collect()}
    plain = Plain([t for i, t in texts.items() if i % 3], (0.7, 0.8))
    # Words with more tokens than a shard takes are there.
    assert sum(n > 500 for n in plain.total.values()) >= 3
    for r in ngramlm.score(df, F.col("doc_id") % 3 > 0, discounts=(0.7, 0.8)).collect():
        same(r, plain.scores(texts[r.id]))


def test_odd_rows(spark, odd, long_text):
    train = ~held_out("doc_id", 1)
    rows = ngramlm.score(odd, train).collect()
    given = odd.withColumn("train", train).collect()
    plain = Plain(r.text for r in given if r.train)
    assert sorted(str(r.id) for r in rows) == sorted(str(r.doc_id) for r in given)
    texts = {r.doc_id: r.text for r in given}
    for r in rows:
        same(r, plain.scores(texts[r.id]))
    # Null, empty and blank texts are one closing token.
    assert len({(r.n_tokens, r.score) for r in rows if r.id in (1, 2, 3)}) == 1


def test_nothing_learned_and_nothing_at_all(spark, odd, none):
    rows = ngramlm.score(odd, F.lit(None).cast("boolean")).collect()
    assert all(r.base_score == 0 == r.score and r.n_known == 0 == r.train_tokens for r in rows) and len(rows) == 9
    assert ngramlm.score(none, F.lit(True)).count() == 0


def test_a_word_and_a_pair_in_most_of_the_corpus(spark, monkeypatch):
    monkeypatch.setattr(ngramlm, "SHARD_TOKENS", 50)
    monkeypatch.setattr(ngramlm, "BLOCK_BYTES", 500)
    rng = np.random.default_rng(1)
    texts = [" ".join(x for w in rng.integers(0, 40, 12) for x in ("of", "the", f"w{w}")) for _ in range(60)] + ["of the new", "THE of"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    plain = Plain(texts[:60], (0.6, 0.6))
    for r in ngramlm.score(df, F.col("doc_id") < 60, discounts=(0.6, 0.6)).collect():
        same(r, plain.scores(texts[r.id]))


def test_probabilities_of_a_context_sum_to_one():
    plain = Plain(["a b c a b", "b c", "a a b"])
    words = [w for (w,) in plain.c[0]] + [b"unknown"]
    for context in [(), (b"a",), (b"a", b"b"), ("begin", b"b"), (b"zz", b"a")]:
        assert sum(plain.p(context, w) for w in words) == pytest.approx(1)


@given(st.lists(st.integers(0, 1 << 45), max_size=600), st.lists(st.integers(0, 1 << 46), max_size=50))
@settings(max_examples=60, deadline=None)
def test_elias_fano(values, asked):
    values = np.sort(np.array(values, np.int64))
    level, end = EliasFano.view(np.frombuffer(EliasFano.build(values).to_bytes(), np.uint8))
    assert (level.access(np.arange(len(values))) == values).all()
    x = np.array([*asked, *values, *(values + 1)], np.int64)
    assert (level.successor(x) == np.searchsorted(values, x)).all()


def test_elias_fano_is_small_and_refuses():
    values = np.sort(np.random.default_rng(0).integers(0, 1 << 30, 200_000))
    assert 8 * len(EliasFano.build(values).to_bytes()) < (2.5 + math.log2((1 << 30) / 200_000)) * 200_000
    with pytest.raises(ValueError):
        EliasFano.build(np.array([2, 1]))


def test_trie_in_a_mapped_file(tmp_path):
    rng = np.random.default_rng(4)
    third = np.unique(rng.integers(0, 30, (3000, 3)), axis=0)
    second = np.unique(np.vstack([third[:, :2], rng.integers(0, 40, (200, 2))]), axis=0)
    p = {"weight_1": rng.random(len(np.unique(second[:, 0]))), "p_2": rng.random(len(second)), "weight_2": rng.random(len(second)), "p_3": rng.random(len(third))}
    path = tmp_path / "trie"
    path.write_bytes(Trie.build(second, third, p))
    trie = Trie.mapped(path)
    asked = rng.integers(-1, 42, (5000, 3))
    found = trie.look_up(asked)
    firsts = dict(zip(np.unique(second[:, 0]).tolist(), p["weight_1"]))
    pairs, triples = {tuple(g): i for i, g in enumerate(second.tolist())}, {tuple(g): i for i, g in enumerate(third.tolist())}
    for i, (u, v, w) in enumerate(asked.tolist()):
        expected = {"weight_1": firsts.get(u), "p_2": None, "weight_2": None, "p_3": None}
        if (u, v) in pairs:
            expected |= {"p_2": p["p_2"][pairs[u, v]], "weight_2": p["weight_2"][pairs[u, v]]}
        if (u, v, w) in triples:
            expected["p_3"] = p["p_3"][triples[u, v, w]]
        for name, value in expected.items():
            code = found[name][i]
            assert code == 0 if value is None else abs((1.0 - code) / STEPS - math.log10(value)) <= 0.5001 / STEPS
