import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from logloom.llm import queries, tokencount
from logloom.llm.common import table

PATH = queries.tokenizer("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def counts(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_query_equals_the_library(spark, library):
    docs = {r.doc_id: r.text or "" for r in table(spark, SF, "documents").collect()}
    want = dict(zip(docs, counts(library, list(docs.values()))))
    rows = queries.op6_tokens(spark, SF).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == want and len(rows) == len(docs)
    assert all(r.n_bytes == len(docs[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 1024) for r in rows)


def test_strange_texts_equal_the_library(library):
    random.seed(9)
    parts = ["'", "s", "t", "r", "e", "v", "l", "d", "m", " ", "  ", "\n", "\t", "a", "é", "1", "²", "日", "!", "-", "\x1c", "\x85", "\u2003",
             "<|endoftext|>", "<|endof", "🎉", "R", "'re", "'ll", " '", "ʼ", "\r\n", "\x00"]
    texts = ["".join(random.choice(parts) for _ in range(random.randrange(30))) for _ in range(5000)]
    texts += ["a" * 5000, " " * 3000, "ab" * 999 + "!", "0" * 700, ""]
    own = tokencount.load(PATH)
    assert own.count_texts(texts) == counts(library, texts)
    assert [own.count_texts([t])[0] for t in texts[:500]] == counts(library, texts[:500])


def test_scan_over_chunks_equals_one_run():
    """Composed state maps against the machine run character by character."""
    random.seed(10)
    kinds = np.array([random.randrange(tokencount._CLASSES) for _ in range(5000)], np.uint8)
    first = np.array([0, 1, 700, 701, 2500])
    runs = [tokencount.stretches(kinds, first, width).tolist() for width in (1, 3, 256, 8192)]
    assert all(r == runs[0] for r in runs)
    state, begins = tokencount._START, set()
    for i, k in enumerate(kinds):
        if i in first:
            if state in (tokencount._QR, tokencount._QV, tokencount._QL):
                begins.add(i - 1)
            state = tokencount._START
        out = tokencount._OUT[state, k]
        begins |= {i} if out & tokencount._HERE else set()
        begins |= {i - 1} if out & tokencount._BEFORE else set()
        state = int(tokencount._NEXT[state, k])
    if state in (tokencount._QR, tokencount._QV, tokencount._QL):
        begins.add(len(kinds) - 1)
    assert runs[0] == sorted(begins)


def test_forgetting_changes_nothing(library):
    own = tokencount.Vocabulary(PATH)
    text = ["The quick brown fox's 1234 été, naïvely."]
    before = own.count_texts(text)
    own.clear()
    assert own.count_texts(text) == before == counts(library, text)


def test_odd_rows(spark, odd, none, library):
    rows = tokencount.count_tokens(odd, PATH, keep=("doc_id", "id")).collect()
    texts = [r.text or "" for r in odd.collect()]
    assert sorted(r.n_tokens for r in rows) == sorted(counts(library, texts))
    assert sorted(r.n_bytes for r in rows) == sorted(len(t.encode()) for t in texts)
    assert tokencount.count_tokens(none, PATH).count() == 0
