import re
from collections import Counter

import numpy as np
import pytest

from logloom.llm import ngramratio, queries
from logloom.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.01"


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_base_and_verdict(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    rows = {r.doc_id: r for r in queries.op7_rules(spark, SF).collect()}
    assert rows.keys() == docs.keys()
    weights = plain_weights(docs, labels)
    for i, r in rows.items():
        n_words, chars, symbols, lines, repeats = plain(docs[i])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n_words, chars, symbols, lines, repeats)
        assert r.base_failed == (n_words < 10 or 100 * repeats > 20 * n_words)
        buckets = plain_buckets(docs[i])
        ratio = sum(weights[b] for b in buckets) / max(len(buckets), 1)
        assert r.kept == (not r.base_failed and ratio >= -0.25) or abs(ratio + 0.25) < 1e-9
    good = [rows[i].kept for i, q in labels.items() if q == 1 and not rows[i].base_failed]
    poor = [rows[i].kept for i, q in labels.items() if q == 0]
    assert np.mean(good) == 1 and np.mean(poor) < 0.1


def plain_buckets(text):
    data = (text or "").encode()
    return [int.from_bytes(data[i : i + 3], "little") * 2654435761 % 2**32 >> 19 for i in range(len(data) - 2)]


def plain_weights(docs, labels):
    target, raw = np.zeros(ngramratio.BUCKETS), np.zeros(ngramratio.BUCKETS)
    for i, text in docs.items():
        counts = np.bincount(plain_buckets(text), minlength=ngramratio.BUCKETS)
        raw += counts
        if labels.get(i) == 1:
            target += counts
    return ngramratio.weigh(target, raw)


@pytest.mark.parametrize("size", [1 << 20, 64])
def test_grams_in_blocks_and_pieces(monkeypatch, size):
    monkeypatch.setattr(ngramratio, "_SIZE", size)
    texts = [b"abcdefgh" * 30, None, b"", b"ab", "déjà".encode(), b"xyz" * 7]
    found = [[] for _ in texts]
    for row, bucket in ngramratio._grams(texts):
        for r, b in zip(row, bucket):
            found[r].append(int(b))
    assert found == [plain_buckets((t or b"").decode()) for t in texts]


def test_long_text(long_text):
    assert tuple(ngramratio.stats(long_text.encode())) == (360_000, len(long_text.replace(" ", "")), 0, 0, 360_000)


def test_odd_rows(spark, odd, none):
    weights = ngramratio.fit(odd, odd.filter("doc_id = 5").select("doc_id"))
    rows = ngramratio.judge(odd, weights).collect()
    assert len(rows) == odd.count()
    assert {r.doc_id for r in rows if r.n_words == 0} == {1, 2, 3} and all(r.base_failed for r in rows if r.doc_id in (1, 2, 3, 5, 8))
    assert not ngramratio.fit(odd, none.select("doc_id")).any()
    assert not ngramratio.fit(none, odd.select("doc_id")).any() and ngramratio.judge(none, weights).count() == 0
