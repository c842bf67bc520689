import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from logloom.llm import pieces, queries
from logloom.llm.common import table

PATH = queries.tokenizer("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_equal_the_library_and_decode_to_the_text(spark, library):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    encoded = pieces.encode(table(spark, SF, "documents"), PATH)
    rows = encoded.collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.ids == library.encode(docs[r.doc_id]) and r.n_ids == len(r.ids) and r.round_trip
    decoded = {r.doc_id: r.decoded for r in pieces.decode(encoded, PATH).collect()}
    assert decoded == docs == {r.doc_id: library.decode(r.ids) for r in rows}


def test_strange_texts_equal_the_library(library):
    random.seed(4)
    parts = ["a", "the ", " ", "  ", "\n", "\t", "é", "ñandú", "日本", "🎉", ".", ",", "!!", "***", "{}();\r\n", "don't", "▁", "x1", "\x00", "==", "ſ"]
    texts = ["".join(random.choice(parts) for _ in range(random.randrange(30))) for _ in range(3000)]
    own = pieces.load(PATH)
    for text in texts + ["a" * 3000, " " * 500, "=" * 999]:
        ids = np.frombuffer(own.encode(text), np.int32).tolist()
        assert ids == library.encode(text), text
        assert own.decode(ids) == text.replace("▁", " ")


def test_cutting_long_texts_changes_nothing(library, long_text):
    text = long_text[:2_500_000] + "  end"
    assert np.frombuffer(pieces.load(PATH).encode(text), np.int32).tolist() == library.encode(text)


def test_unigram_path_has_the_best_score():
    """Against all segmentations, over a vocabulary of random scores."""
    own = pieces.Pieces(PATH)
    random.seed(5)
    own.bpe, own.ids = False, {}
    own.automaton = pieces.ahocorasick.Automaton()
    for k, piece in enumerate(["a", "b", "ab", "ba", "aab", "bab", "abba", "bb"]):
        own.ids[piece] = k
        own.automaton.add_word(piece, (len(piece), k))
    own.automaton.make_automaton()
    own.scores = [-random.random() * 5 for _ in own.ids]

    def best(text):
        if not text:
            return 0.0
        return max(own.scores[i] + best(text[len(p) :]) for p, i in own.ids.items() if text.startswith(p))

    for _ in range(200):
        text = "".join(random.choice("ab") for _ in range(random.randrange(1, 11)))
        path = own.best_path(text)
        names = {i: p for p, i in own.ids.items()}
        assert "".join(names[i] for i in path) == text
        assert sum(own.scores[i] for i in path) == pytest.approx(best(text))


def test_odd_rows(spark, odd, none):
    rows = pieces.encode(odd, PATH).collect()
    assert len(rows) == odd.count() and all(r.round_trip for r in rows)
    assert {r.doc_id for r in rows if not r.n_ids} == {1, 2}
    assert pieces.encode(none, PATH).count() == 0
    lost = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r.decoded for r in pieces.decode(lost, PATH).collect()} == {""}


def test_round_trip_is_what_decoding_gives(spark):
    texts = ["a▁b", "▁", "a b", "", None, " lead", "tail ", "é\n\t x"]
    encoded = pieces.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PATH)
    trips = {r.doc_id: r.round_trip for r in encoded.collect()}
    decoded = {r.doc_id: r.decoded for r in pieces.decode(encoded, PATH).collect()}
    assert trips == {i: decoded[i] == (t or "") for i, t in enumerate(texts)}
    assert [trips[i] for i in range(len(texts))] == [False, False] + [True] * 6


def test_a_worker_keeps_little_for_the_next_task(spark, library):
    """Words that never come again: what a task remembered of them is gone when the next task begins in its process."""
    words = [" ".join(f"{k}w{i:x}q{i * 7919 % 99991:x}" for i in range(80_000)) for k in range(4)]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string").repartitionByRange(4, "doc_id")
    for r in pieces.encode(docs, PATH).collect():
        assert r.ids == library.encode(words[r.doc_id])

    def held(batches):
        own = pieces.load(PATH)
        for batch in batches:
            n = len(own.memo) + len(own.memo.last) + len(own.joins)
            yield pa.RecordBatch.from_arrays([pa.array([n] * batch.num_rows, pa.int64())], ["n"])

    assert max(r.n for r in spark.range(0, 8, 1, 8).mapInArrow(held, "n long").collect()) <= 1 << 16
