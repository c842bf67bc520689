import json

import pytest
from pyspark.sql import functions as F

from logloom.sources import logs
from tests.logfiles import write


def _kinds(spark, lines):
    df = spark.createDataFrame([("f.log", line) for line in lines], "source_file string, line string")
    return {r.line: r.kind for r in logs.parse_lines(df).collect()}


@pytest.mark.parametrize(
    "line,kind",
    [
        ('{"a":1}', "event"),
        ('{"a":1,"a":2}', "event"),
        ('{"trace.method":{"event.action":"x"}}', "trace"),
        ('{"trace.method":null}', "event"),
        ('{"a":1', "malformed"),
        ('{"a":1} xyz', "malformed"),
        ('{"a":1}]', "malformed"),
        ('{"a":1},{"b":2}', "malformed"),
        ('{"a":1}] "x"', "malformed"),
        ("123", "malformed"),
        ("[1]", "malformed"),
        ("null", "malformed"),
        ('"text"', "malformed"),
    ],
)
def test_kind_of_a_line(spark, line, kind):
    assert _kinds(spark, [line]) == {line: kind}


def test_last_duplicate_key_wins(spark):
    df = spark.createDataFrame([("f.log", '{"a":1,"a":2}')], "source_file string, line string")
    assert logs.parse_lines(df).select(F.try_variant_get("doc", "$.a", "int")).first()[0] == 2


def test_scan_trims_and_skips_blank_lines(spark, folder, rows):
    write(f"{folder}/x-2026-01-01.log", ['  {"a":1}\t', "", "   ", ' {"b":2}\r'])
    found = rows(logs.scan_lines(spark, f"{folder}/*.log", logs.root_of(spark, f"{folder}/*.log")))
    assert [r["line"] for r in found] == ['{"a":1}', '{"b":2}']
    assert {r["source_file"] for r in found} == {"x-2026-01-01.log"}


def _lines(spark, *lines):
    return spark.createDataFrame(list(lines), "source_file string, line string")


def test_copies_are_numbered_and_ids_are_stable(spark, rows):
    df = _lines(spark, ("a", "x"), ("a", "x"), ("a", "y"), ("b", "x"))
    first = rows(logs.with_raw_id(logs.number_copies(df)))
    again = rows(logs.with_raw_id(logs.number_copies(df.repartition(3))))
    assert first == again
    assert len({r["raw_id"] for r in first}) == 4
    assert [r["occurrence"] for r in first if (r["source_file"], r["line"]) == ("a", "x")] == [1, 2]


def test_many_copies_are_cut_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(logs, "COPIES_PER_TASK", 10)
    df = spark.range(95).select(F.lit("f").alias("source_file"), F.when(F.col("id") < 85, "hot").otherwise("cold").alias("line"))
    numbered = logs.number_copies(df)
    got = {r.line: (r.n, r.distinct, r.top) for r in numbered.groupBy("line").agg(
        F.count("*").alias("n"), F.count_distinct("occurrence").alias("distinct"), F.max("occurrence").alias("top")).collect()}
    assert got == {"hot": (85, 85, 85), "cold": (10, 10, 10)}


def test_quality_report_counts_malformed_lines(spark, rows):
    df = _lines(spark, ("a", '{"x":1}'), ("a", "{"), ("b", '{"trace.method":{}}'))
    assert rows(logs.quality_report(logs.parse_lines(df))) == [
        {"source_file": "a", "traces": 0, "events": 1, "malformed": 1, "unreadable_ids": 0},
        {"source_file": "b", "traces": 1, "events": 0, "malformed": 0, "unreadable_ids": 0},
    ]


def test_fingerprint(spark, folder, rows):
    import hashlib

    write(f"{folder}/x.log", [json.dumps({"a": 1})])
    with open(f"{folder}/x.log", "rb") as f:
        digest = hashlib.sha256(f.read()).hexdigest()
    assert rows(logs.fingerprints(spark, f"{folder}/*.log")) == [{"source_file": "x.log", "checksum": digest}]
