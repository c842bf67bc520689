import datetime

import pytest
from pyspark.sql import functions as F

from logloom import functions as fn

AT = datetime.datetime


@pytest.mark.parametrize(
    "text,api,cobrand",
    [
        ("Sun, 12 Jul 2026 00:00:04 AM", AT(2026, 7, 12, 0, 0, 4), None),
        ("Sun, 12 Jul 2026 00:00:04 PM", AT(2026, 7, 12, 12, 0, 4), None),
        ("Sun, 12 Jul 2026 12:00:04 AM", AT(2026, 7, 12, 0, 0, 4), None),
        ("Sun, 12 Jul 2026 12:00:04 PM", AT(2026, 7, 12, 12, 0, 4), None),
        ("Fri, 17 Jul 2026 18:13:04 PM", AT(2026, 7, 17, 18, 13, 4), None),
        ("Fri, 17 Jul 2026 18:13:04 AM", AT(2026, 7, 17, 18, 13, 4), None),
        ("Mon, 12 Jul 2026 1:00:04 pm", AT(2026, 7, 12, 13, 0, 4), None),
        ("Sun, 12 Jul 2026 01:00:04PM", AT(2026, 7, 12, 1, 0, 4), None),
        ("Sun, 12 Jul 2026 18:00:04", AT(2026, 7, 12, 18, 0, 4), None),
        ("Sun, 31 Feb 2026 01:00:04 PM", None, None),
        ("Sun, 12 Jul 2026 01:00:60 PM", None, None),
        ("Sun, 12 July 2026 01:00:04 PM", None, None),
        ("garbage", None, None),
        ("Tue, 21 Jul 2026, 00:00:47 pm", None, AT(2026, 7, 21, 12, 0, 47)),
        ("Tue, 21 Jul 2026, 11:59:59 PM", None, AT(2026, 7, 21, 23, 59, 59)),
    ],
)
def test_times(spark, text, api, cobrand):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(fn.parse_api_time("t"), fn.parse_cobrand_time("t")).first()
    assert tuple(row) == (api, cobrand)


def _one(spark, value, function):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(function(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "action,prefix",
    [(None, None), ("heartbeat", "heartbeat"), ("posting_job.twitter.failed", "posting_job"),
     ("content.cobrand.render", "content.cobrand"), ("content.cobrand", "content"), (".x", "")],
)
def test_event_prefix(spark, action, prefix):
    assert _one(spark, action, fn.event_prefix) == prefix


@pytest.mark.parametrize(
    "message,pattern",
    [
        ("foo 12\r\nbar", "foo {n}"),
        ("foo 12\nbar", "foo {n}"),
        ("at 0x396bc380", "at {hex}"),
        ("id 00000000-0000-4000-8000-0000000000ff ok", "id {uuid} ok"),
        ("at 2026-07-12T10:00:00Z and 2026-07-12T10:00:00+02:00", "at {timestamp} and {timestamp}"),
        (None, None),
    ],
)
def test_message_pattern(spark, message, pattern):
    assert _one(spark, message, fn.message_pattern) == pattern


def test_normalizing_twice_changes_nothing(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(fn.normalize_message(F.col("text")).alias("n"))
    assert df.where(fn.normalize_message(F.col("n")) != F.col("n")).count() == 0


@pytest.mark.parametrize(
    "pattern,signature",
    [
        ("FFPROBE exited with code {n}", "FFPROBE_INVALID_MEDIA"),
        ("ffprobe exited: moov atom not found", "FFPROBE_INVALID_MEDIA"),
        ("Twitter token validation failed", "TWITTER_TOKEN_INVALID"),
        ("never seen", "never seen"),
        (None, None),
    ],
)
def test_signature(spark, pattern, signature):
    assert _one(spark, pattern, fn.resolve_signature) == signature


@pytest.mark.parametrize(
    "row,label",
    [
        (("a.b", "SIG", None, "p", None, None), "a.b"),
        ((None, "SIG", "comp", "p", None, None), "SIG (comp)"),
        ((None, "SIG", None, "p", None, None), "SIG"),
        ((None, "p", "comp", "p", "text", None), "Uninstrumented Error"),
        ((None, None, None, None, None, "text"), "Uninstrumented Error"),
        ((None, None, None, None, None, None), "Unknown Event"),
    ],
)
def test_event_label(spark, row, label):
    names = ["a", "s", "c", "p", "m", "e"]
    df = spark.createDataFrame([row], ", ".join(f"{n} string" for n in names))
    assert df.select(fn.event_label(*[F.col(n) for n in names])).first()[0] == label


@pytest.mark.parametrize("search,found", [("50%", ["50 percent", "50% off"]), ("a_c", ["abc"]), ("\\d", ["C:\\dir"]), ("ABC", ["abc"])])
def test_search_wildcards_and_backslash(spark, search, found):
    texts = ["50 percent", "50% off", "abc", "C:\\dir"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert sorted(r.t for r in df.where(fn.contains_text(("t",), search)).collect()) == sorted(found)


def test_bounds_are_inclusive_and_unreadable_times_drop_out(spark):
    df = spark.createDataFrame([(AT(2024, 1, 1),), (AT(2024, 1, 2),), (AT(2024, 1, 2, 0, 0, 1),), (None,)], "parsed_event_time timestamp_ntz")
    assert fn.within(df, "2024-01-01", "2024-01-02").count() == 2
