"""Daily rollups against the figures taken from the facts."""

import datetime
import random

import pytest

from logloom.operators import metrics, rollups

DAY = datetime.date(2024, 3, 1)
_EVENTS = "parsed_event_time timestamp_ntz, level string, event_action string, user_id bigint, request_id string, duration_ms double"
_SPANS = "parsed_event_time timestamp_ntz, error_message string"


@pytest.fixture(scope="module")
def facts(spark):
    random.seed(3)

    def time():
        return random.choice([None, *[datetime.datetime(2024, 3, d, random.randrange(24), 5) for d in range(1, 9)]])

    ids = [None, 0, -1, -40_000, 1, 32_768, 32_769, 2**40, *range(100, 160)]
    events = [
        (time(), random.choice(["error", "ERROR", "warn", "info", None]), "posting_job_x", random.choice(ids), f"r{random.randrange(900)}", random.choice([None, 1.5, 4.0]))
        for _ in range(4000)
    ]
    spans = [(time(), random.choice([None, "e"])) for _ in range(500)]
    return spark.createDataFrame(events, _EVENTS), spark.createDataFrame(spans, _SPANS)


@pytest.mark.parametrize("first, last", [(1, 8), (3, 5), (4, 4), (20, 21)])
def test_any_range_of_days_equals_the_facts(facts, first, last):
    days = [DAY.replace(day=d) for d in (first, last)]
    got = rollups.kpis(rollups.daily_figures(*facts), rollups.daily_users(facts[0]), *days).collect()
    want = metrics.kpis(*facts, f"{days[0]} 00:00:00", f"{days[1]} 23:59:59.999999").collect()
    assert len(got) == len(want) == 1 and got[0].asDict().keys() == want[0].asDict().keys()
    for name, value in want[0].asDict().items():
        if name == "requests":
            assert abs(got[0].requests - value) <= 0.08 * value
        else:
            assert got[0][name] == (pytest.approx(value) if value is not None else None), name


def test_stacked_loads_merge_to_those_of_all_rows(facts):
    events, spans = facts
    parts = [(events.where(p), spans.where(p)) for p in ("hour(parsed_event_time) < 9", "hour(parsed_event_time) >= 9")]
    figures, again = (rollups.daily_figures(*part) for part in parts)
    users, more = (rollups.daily_users(part[0]) for part in parts)
    stacked, both = figures.unionByName(again), users.unionByName(more)
    merged, blocks = rollups.merge_figures(stacked), rollups.merge_users(both)
    plain = rollups.daily_figures(*facts).drop("requests", "duration_sum").collect()
    assert sorted(map(str, merged.drop("requests", "duration_sum").select(*plain[0].asDict()).collect())) == sorted(map(str, plain))
    assert sorted(map(str, blocks.collect())) == sorted(map(str, rollups.daily_users(events).collect()))
    one, two = (rollups.kpis(*tables, "2024-03-01", "2024-03-08").drop("requests").collect() for tables in ((merged, blocks), (stacked, both)))
    assert one == two


def test_no_rows(facts):
    none = [df.limit(0) for df in facts]
    row = rollups.kpis(rollups.daily_figures(*none), rollups.daily_users(none[0]), "2024-03-01", "2024-03-08").first()
    assert (row.total_events, row.unique_users, row.requests, row.error_rate, row.avg_duration_ms) == (0, 0, 0, 0.0, None)
