import datetime

from hypothesis import given, settings
from hypothesis import strategies as st

from logloom import schemas
from logloom.operators.upsert import update, upsert

AT = datetime.datetime
OLD = "key string, n int, first timestamp_ntz, status string, note string"
NEW = "key string, n int, first timestamp_ntz"


def _merge(current, incoming):
    return upsert(current, incoming, ("key",), ("n",), ("first",), {"status": "Pending"})


def test_ownership(spark, rows):
    current = spark.createDataFrame(
        [
            ("seen earlier", 1, AT(2024, 1, 5), "Classified", "mine"),
            ("seen later", 1, AT(2024, 1, 1), None, None),
            ("time unknown", 1, AT(2024, 1, 1), "Ignored", None),
            ("stale", 9, None, None, "kept"),
        ],
        OLD,
    )
    incoming = spark.createDataFrame(
        [("seen earlier", 2, AT(2024, 1, 2)), ("seen later", None, AT(2024, 1, 2)), ("time unknown", 3, None), ("new", 4, AT(2024, 1, 3)), (None, 5, None)],
        NEW,
    )
    assert {r["key"]: tuple(r.values())[1:] for r in rows(_merge(current, incoming))} == {
        "seen earlier": (2, AT(2024, 1, 2), "Classified", "mine"),
        "seen later": (None, AT(2024, 1, 1), "Pending", None),
        "time unknown": (3, AT(2024, 1, 1), "Ignored", None),
        "stale": (9, None, None, "kept"),
        "new": (4, AT(2024, 1, 3), "Pending", None),
    }


_ROW = st.tuples(st.sampled_from("abcd"), st.integers(0, 9), st.none() | st.sampled_from([AT(2024, 1, d) for d in (1, 2, 3)]))


@settings(max_examples=8, deadline=None)
@given(st.lists(_ROW, max_size=4, unique_by=lambda r: r[0]), st.lists(_ROW, min_size=1, max_size=4, unique_by=lambda r: r[0]))
def test_merging_twice_is_merging_once(spark, old, new):
    current = spark.createDataFrame([(*r, None, None) for r in old], OLD)
    incoming = spark.createDataFrame(new, NEW)
    once = _merge(current, incoming)
    assert sorted(once.collect(), key=str) == sorted(_merge(once, incoming).collect(), key=str)


def test_update_ignores_unknown_keys(spark, rows):
    current = spark.createDataFrame([("a", 1, None, "x", None)], OLD)
    changes = spark.createDataFrame([("a", 5), ("b", 6)], "key string, n int")
    assert [(r["key"], r["n"], r["status"]) for r in rows(update(current, changes, ("key",)))] == [("a", 5, "x")]


def test_conform_renames_adds_and_keeps(spark):
    old = spark.createDataFrame([("p", "entered by hand")], "message_pattern string, extra string")
    new = schemas.conform(old, schemas.INSTRUMENTATION_GAP_CATALOG, {"message_pattern": "raw_pattern"})
    row = new.first()
    assert (row.raw_pattern, row.extra, row.signature) == ("p", "entered by hand", None)
    assert new.columns[:-1] == schemas.INSTRUMENTATION_GAP_CATALOG.names
