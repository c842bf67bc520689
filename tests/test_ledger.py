"""The ledger of files: what a refresh reads, what it does again after a failure, and what it costs to have much history."""

import pytest
from pyspark.sql import functions as F

from logloom.plans import refresh
from logloom.sources import ledger, logs
from logloom.sources.tables import Warehouse
from tests.logfiles import API_DAY, STANDALONE, TRACE, standard, write

DAY = "application-2026-07-12.log"


def _entries(warehouse, step):
    return sorted((r.source_file, r.rows) for r in ledger.latest(warehouse.read("file_ledger"), step).collect())


def test_a_refresh_without_new_files_reads_the_ledger_only(spark, folder, monkeypatch):
    folders = standard(folder)
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    assert refresh.refresh_api(warehouse, folders.api) == (1, 0)
    assert refresh.refresh_cobrand(warehouse, folders.cobrand) == (1, 0)
    assert _entries(warehouse, "raw_api") == [(DAY, 6)] and _entries(warehouse, "event_fact_api") == [(DAY, 5)]
    assert _entries(warehouse, "span_fact") == [("application-2026-07-21.log", 2)]
    read, plain = set(), Warehouse.read
    monkeypatch.setattr(Warehouse, "read", lambda self, table: read.add(table) or plain(self, table))
    assert refresh.refresh_api(warehouse, folders.api) == (0, 0)
    assert refresh.refresh_cobrand(warehouse, folders.cobrand) == (0, 0)
    assert read == {"file_ledger"}


@pytest.mark.parametrize("step", ["raw_api", "event_fact_api", "event_shares", "event_catalog_api"])
def test_a_step_that_died_before_its_entry_is_done_again(spark, folder, monkeypatch, rows, step):
    folders = standard(folder)
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    note = Warehouse.note

    def dying(self, target, *args):
        if target == step:
            raise RuntimeError("the driver is gone")
        note(self, target, *args)

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "note", dying)
        with pytest.raises(RuntimeError):
            refresh.refresh_api(warehouse, folders.api)
    assert _entries(warehouse, step) == []
    refresh.refresh_api(warehouse, folders.api)
    assert warehouse.read("event_fact_api").count() == len(API_DAY)
    assert [r["event_count"] for r in rows(warehouse.read("capability_catalog"))] == [2]


def test_an_audit_finds_half_written_files_and_fills_an_empty_ledger(spark, folder):
    folders = standard(folder)
    write(f"{folder}/logs/api/application-2026-07-13.log", API_DAY)
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    refresh.refresh_api(warehouse, folders.api)
    refresh.refresh_cobrand(warehouse, folders.cobrand)
    assert refresh.audit(warehouse).count() == 0
    half = warehouse.read("event_fact_api").where(F.col("source_file") == DAY).limit(3).collect()
    warehouse.append("event_fact_api", spark.createDataFrame(half, warehouse.read("event_fact_api").schema))
    before = warehouse.read("event_fact_api").count()
    found = {(r.step, r.source_file, r.rows) for r in refresh.audit(warehouse).collect()}
    assert ("event_fact_api", DAY, None) in found and {f for _, f, _ in found} == {DAY}
    assert refresh.refresh_api(warehouse, folders.api) == (0, 0)
    assert before < warehouse.read("event_fact_api").count() == 2 * len(API_DAY)
    assert refresh.audit(warehouse).count() == 0

    # A warehouse from before there was a ledger.
    fs, target = warehouse._fs(f"{folder}/warehouse/file_ledger")
    fs.delete(target, True)
    assert refresh.audit(warehouse).count() > 0
    assert refresh.refresh_api(warehouse, folders.api) == (0, 0)
    assert refresh.refresh_cobrand(warehouse, folders.cobrand) == (0, 0)
    assert warehouse.read("event_fact_api").count() == 2 * len(API_DAY)


def test_rounds_give_what_one_load_gives(spark, folder, rows, monkeypatch):
    for day in range(1, 6):
        write(f"{folder}/logs/cobrand-2026-07-0{day}.log", [TRACE, STANDALONE] * day)
    write(f"{folder}/logs/cobrand-2026-07-06.log", ["", "no json"])
    whole, rounds = Warehouse(spark, f"{folder}/whole"), Warehouse(spark, f"{folder}/rounds")
    assert refresh.refresh_cobrand(whole, f"{folder}/logs/*.log") == (6, 0)
    monkeypatch.setattr(ledger, "FILES_PER_ROUND", 2)
    assert refresh.refresh_cobrand(rounds, f"{folder}/logs/*.log") == (6, 0)
    for table in ("raw_cobrand", "span_fact", "cobrand_event_fact", "span_shares", "gap_shares", "dim_span", "file_ledger"):
        columns = [c for c in whole.read(table).columns if c not in ("doc", "discovered_at", "batch", "recorded_at")]
        assert rows(rounds.read(table), *columns) == rows(whole.read(table), *columns), table
    assert dict(_entries(rounds, "span_fact"))["cobrand-2026-07-06.log"] == 0


def test_a_long_history_is_neither_listed_nor_opened(spark, folder):
    folders = standard(folder)
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    refresh.refresh_api(warehouse, folders.api)
    past = spark.range(50_000).select(F.format_string("past-%d.log", "id").alias("source_file"), F.lit(0).cast("bigint").alias("rows"))
    for step in ("raw_api", "event_fact_api", "event_shares", "event_catalog_api", "gap_shares_api", "instrumentation_gap_catalog_api"):
        warehouse.enter(step, past)
    write(f"{folder}/logs/api/application-2026-07-13.log", API_DAY[:2])
    assert refresh.refresh_api(warehouse, folders.api) == (1, 0)
    assert warehouse.read("event_fact_api").count() == len(API_DAY) + 2
    files = spark.createDataFrame([("application-2026-07-13.log",)], "source_file string")
    only = refresh._only(warehouse.read("raw_api"), files)
    plan = only._jdf.queryExecution().optimizedPlan().toString()
    assert "dynamicpruning" in plan and "past-" not in plan and "INSET" not in plan
    assert only.count() == 2


def test_a_file_that_was_stored_again_is_pending_again(spark):
    schema = "step string, source_file string, rows bigint, batch bigint"
    entries = [("raw", "a", 3, 1), ("fact", "a", 3, 2), ("raw", "b", 3, 1), ("fact", "b", 3, 2), ("raw", "b", 4, 3),
               ("raw", "c", 1, 1), ("fact", "c", 1, 2), ("fact", "c", None, 4), ("raw", "d", 0, 1), ("raw", "e", 1, 1), ("raw", "e", None, 5)]
    book = spark.createDataFrame(entries, schema)
    found = sorted((r.source_file, r.rows) for r in ledger.pending(book, "raw", "fact").collect())
    assert found == [("b", 4), ("c", 1), ("d", 0)]
    assert ledger.pending(book.limit(0), "raw", "fact").count() == 0


def test_files_that_changed_after_their_load(spark, folder):
    folders = standard(folder)
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    refresh.refresh_api(warehouse, folders.api)
    assert ledger.altered(warehouse.read("file_ledger"), "raw_api", logs.list_files(spark, folders.api)).count() == 0
    with open(f"{folder}/logs/api/{DAY}", "a", encoding="utf-8") as out:
        out.write("one more\n")
    grown = ledger.altered(warehouse.read("file_ledger"), "raw_api", logs.list_files(spark, folders.api)).collect()
    assert [(r.source_file, r.length - r.loaded_length) for r in grown] == [(DAY, 9)]
