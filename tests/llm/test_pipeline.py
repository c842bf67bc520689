"""The pipeline against its stages done by hand in plain Python."""

import re

import pytest
import sentencepiece

import corpus_pipeline
from logloom.llm import nbsvm, queries, secretscan
from logloom.llm.common import table
from tests.llm.test_mixing import plain as plain_targets
from tests.llm.test_similar import kept_by_brute_force

SF = "/root/testdata/sf0.001"
NAMES = ["quality classifier", "SimHash near-dedup", "secret scans", "mixing to target weights", "SentencePiece encoding"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    docs, out = table(spark, SF, "documents"), [table(spark, SF, "documents").collect()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        out.append(docs.collect())
    return out


def test_names_and_columns(spark, stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    columns = table(spark, SF, "documents").columns
    assert all(list(rows[0].asDict()) == columns for rows in stages[:-1])
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality_stage_keeps_the_good(spark, stages):
    model = queries.quality_model(table(spark, SF, "documents"), table(spark, SF, "labels"))
    scores = nbsvm.scores([(r.text or "").encode() for r in stages[0]], model)
    assert sorted(map(str, stages[1])) == sorted(str(r) for r, s in zip(stages[0], scores) if s >= 0.3)
    assert 0 < len(stages[1]) < len(stages[0])


def test_dedup_stage_keeps_one_of_each_group(stages):
    kept = kept_by_brute_force([(r.doc_id, r.text) for r in stages[1]])
    assert sorted(map(str, stages[2])) == sorted(str(r) for r in stages[1] if r.doc_id in kept)
    assert 0 < len(stages[2]) < len(stages[1])


def test_dedup_stage_judges_rows_by_their_texts(spark):
    """Ids may repeat over different texts, one of them a copy; equal rows and rows without an id are there as well."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    rows = [(1, a, 1), (2, a, 2), (2, b, 3), (3, c, 4), (3, d, 5), (3, d, 6), (None, c, 7), (None, "e f g", 8), (None, "e f g", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __node int").repartition(4)
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()), key=str)
    assert kept == sorted([(1, a), (2, b), (3, c), (3, d), (None, "e f g")], key=str)


def test_secret_stage_masks_and_keeps_all(stages):
    before, after = {r.doc_id: r for r in stages[2]}, {r.doc_id: r for r in stages[3]}
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert r.n_chars == len(r.text)
        if not secretscan.suspects([before[i].text.encode()]).any():
            assert r.text == before[i].text
        assert not secretscan.base_spans(r.text)


def test_mixing_stage(stages):
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in stages[3]}
    _, target = plain_targets([(r.source, size[r.doc_id]) for r in stages[3]])
    taken, largest = dict.fromkeys(target, 0), dict.fromkeys(target, 0)
    for r in stages[4]:
        taken[r.source] += size[r.doc_id]
    for r in stages[3]:
        largest[r.source] = max(largest[r.source], size[r.doc_id])
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in target)
    assert {str(r) for r in stages[4]} <= {str(r) for r in stages[3]}


def test_encoding_stage(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer("piece_bpe_32k.model"))
    want = sorted((r.doc_id, library.encode(r.text)) for r in stages[4])
    assert sorted((r.doc_id, r.ids) for r in stages[5]) == want and all(r.round_trip for r in stages[5])


def test_run_is_the_stages(spark, stages):
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, stages[-1]))


def test_odd_rows(spark, odd, none, tmp_path_factory):
    for name, docs in (("odd", odd), ("none", none)):
        folder = str(tmp_path_factory.mktemp(name))
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, SF).write.parquet(f"{folder}/{i}")
            before, docs = docs, spark.read.parquet(f"{folder}/{i}")
            if i < len(corpus_pipeline.STAGES) - 1:
                assert docs.columns == before.columns
    # A row without an id is never dropped as a copy; rows that repeat an id stay once.
    kept = corpus_pipeline.near_duplicates(spark, odd, SF).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in kept} == {1: 1, None: 1, 5: 1, 7: 1, 8: 1}

