"""The whole refresh on hand-written files."""

import glob
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from logloom.operators import archive, catalogs, manifest
from logloom.plans import refresh
from logloom.reports import REPORTS, Reports
from logloom.sources import logs
from logloom.sources.tables import Warehouse
from logloom.streaming.ingest import ingest
from tests.logfiles import API_DAY, STANDALONE, TRACE, standard, write


def _counts(warehouse):
    return {r.table: r.rows for r in warehouse.inventory().collect()}


EXPECTED = {
    "raw_api": 6, "raw_cobrand": 4, "event_fact_api": 5, "span_fact": 8, "span_context": 8, "cobrand_event_fact": 1,
    "event_shares": 5, "gap_shares": 5, "span_shares": 4, "file_ledger": 13, "event_catalog_api": 2, "capability_catalog": 1, "instrumentation_gap_catalog": 3, "dim_span": 4, "archive_manifest": 2,
}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("loaded"))
    folders = standard(folder)
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    refresh.run(warehouse, folders, now="2026-08-01 00:00:00")
    return warehouse, folders, folder


def test_tables(loaded):
    assert _counts(loaded[0]) == EXPECTED


def test_facts(loaded, rows):
    events = rows(loaded[0].read("event_fact_api"), "event_action", "user_id", "parsed_event_time", "message")
    assert sorted(str(e["user_id"]) for e in events) == ["7", "7", "7", "None", "None"]
    assert sum(e["parsed_event_time"] is None for e in events) == 1
    assert "The Max FPS found is 60\r\nstack" in [e["message"] for e in events]
    loose = rows(loaded[0].read("cobrand_event_fact"))[0]
    assert loose["message"] == STANDALONE["message"] and loose["level"] == "error"


def test_the_span_dimension_follows_from_shares(loaded, rows, spark, folder):
    """Shares of single files give the dimension of all spans, and a folded file's spans are not needed again."""
    spans = loaded[0].read("span_fact")
    more = spans.withColumns({"source_file": F.lit("other.log"), "method_name": F.lit("a first method")}).limit(3)
    nameless = spans.withColumns({"event_action": F.lit("never.named"), "method_name": F.lit(None).cast("string"), "source_file": F.lit("third.log")})
    every = spans.unionByName(more).unionByName(nameless).unionByName(more.withColumn("event_action", F.lit(None).cast("string")))
    none = Warehouse(spark, f"{folder}/none").read("dim_span")
    shares = catalogs.fold_spans(every, "source_file")
    assert shares.agg(F.sum("span_count")).first()[0] == every.count()
    found = rows(catalogs.merge_dimension(shares, none, "2026-08-01 00:00:00"))
    assert found == rows(catalogs.sync_dimension(every, none, "2026-08-01 00:00:00"))
    assert {r["event_action"]: r["method_name"] for r in found}["never.named"] is None
    plan = catalogs.merge_dimension(loaded[0].read("span_shares"), loaded[0].read("dim_span"))._jdf.queryExecution().toString()
    assert "span_fact" not in plan


def test_gap_catalog(loaded, rows):
    found = {(r["source_system"], r["signature"]): r for r in rows(loaded[0].read("instrumentation_gap_catalog"))}
    assert set(found) == {("API", "TWITTER_TOKEN_INVALID"), ("API", "VIDEO_MAX_FPS_TOO_LOW"), ("COBRAND", "MEDIA_NOT_READY")}
    fps = found["API", "VIDEO_MAX_FPS_TOO_LOW"]
    assert (fps["raw_pattern"], fps["first_seen"], fps["example_message"]) == ("The Max FPS found is {n}", None, None)
    assert found["COBRAND", "MEDIA_NOT_READY"]["service_name"] == "render"


def test_manifest_is_validated(loaded, rows):
    warehouse, folders, _ = loaded
    found = rows(warehouse.read("archive_manifest"))
    assert [(r["status"], r["json_rows"], r["warehouse_rows"], r["parquet_rows"]) for r in found] == [
        ("VALIDATED", 5, 5, 5), ("VALIDATED", 3, 3, 3)]
    for r in found:
        assert os.path.isdir(r["archive_path"]), r["archive_path"]
    assert manifest.safe_to_purge(warehouse.read("archive_manifest")).count() == 2


def test_archive_holds_the_text(loaded, spark):
    _, folders, folder = loaded
    archived = archive.read_archive(spark, folders.archive)
    with open(f"{folder}/logs/api/application-2026-07-12.log", encoding="utf-8") as f:
        good = [line.strip() for line in f][: len(API_DAY)]
    assert sorted(r.raw_json for r in archived.where("log_type = 'api'").collect()) == sorted(good)
    assert {(r.year, r.month) for r in archived.select("year", "month").collect()} == {("2026", "07")}


def test_running_again_changes_nothing(loaded, rows):
    warehouse, folders, _ = loaded
    before = {t: rows(warehouse.read(t)) for t in ("span_fact", "capability_catalog", "instrumentation_gap_catalog", "dim_span", "archive_manifest")}
    refresh.run(warehouse, folders)
    assert _counts(warehouse) == EXPECTED
    for table, old in before.items():
        assert rows(warehouse.read(table)) == old


def test_reports_run_on_the_warehouse(loaded, rows):
    report = Reports(loaded[0])
    kpi = report.kpis("2026-07-01", "2026-07-31").first()
    assert (kpi.total_events, kpi.errors, kpi.warnings, kpi.unique_users) == (12, 7, 1, 1)
    assert [r["source"] for r in rows(report.search_logs("VIDEO_MAX_FPS_TOO_LOW"))] == ["API"]
    assert report.search_logs("media_not_ready").count() == 1
    assert report.search_logs("x", planner_id=1, source="Cobrand").count() == 0
    assert report.user_timeline(7).count() == 5
    steps = report.workflow_events("request_id", "r1")
    assert steps.count() == 4
    with pytest.raises(ValueError):
        report.workflow_events("message", "x")


def test_dimension_keeps_what_people_entered(loaded, rows):
    warehouse = loaded[0]
    dim = warehouse.read("dim_span").withColumn("layer", F.when(F.col("event_action") == "cobrand.s3.upload", "storage"))
    warehouse.replace("dim_span", dim)
    refresh.sync_span_dimension(warehouse)
    found = {r["event_action"]: r["layer"] for r in rows(warehouse.read("dim_span"))}
    assert found["cobrand.s3.upload"] == "storage" and len(found) == 4
    assert Reports(warehouse).dimension_backlog().count() == 3


def test_back_fill_moves_first_seen_and_human_columns_survive(spark, folder, rows):
    folders = standard(folder)
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    refresh.refresh_api(warehouse, folders.api)
    edited = warehouse.read("capability_catalog").withColumns({"capability": F.lit("Posting"), "classification_status": F.lit("Classified")})
    warehouse.replace("capability_catalog", edited)
    earlier = {"timestamp": "Wed, 01 Jul 2026 05:00:00 AM", "event.action": "posting_job.started", "level": "info"}
    write(f"{folder}/logs/api/application-2026-07-01.log", [earlier])
    refresh.refresh_api(warehouse, folders.api)
    row = rows(warehouse.read("capability_catalog"))[0]
    assert (row["capability"], row["classification_status"], row["event_count"]) == ("Posting", "Classified", 3)
    assert str(row["first_seen"]) == "2026-07-01 05:00:00" and str(row["last_seen"]) == "2026-07-12 18:13:04"


def test_damaged_archive_is_rebuilt(spark, folder):
    folders = standard(folder)
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    refresh.refresh_api(warehouse, folders.api)
    refresh.archive_logs(warehouse, folders, "api")
    part = glob.glob(f"{folders.archive}/log_type=api/**/*.parquet", recursive=True)[0]
    with open(part, "r+b") as f:
        f.truncate(40)
    checksum = os.path.join(os.path.dirname(part), f".{os.path.basename(part)}.crc")
    if os.path.exists(checksum):
        os.remove(checksum)
    refresh.archive_logs(warehouse, folders, "api")
    assert archive.read_archive(spark, folders.archive).count() == 5


def test_lost_row_fails_validation_and_heals(spark, folder, rows):
    folders = standard(folder)
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    refresh.refresh_api(warehouse, folders.api)
    refresh.archive_logs(warehouse, folders, "api")
    kept = warehouse.read("event_fact_api").where("coalesce(event_action, '') <> 'posting_job.failed'").collect()
    warehouse.append("event_fact_api", spark.createDataFrame(kept, warehouse.read("event_fact_api").schema))
    refresh.record(warehouse, folders, "api")
    failed = rows(warehouse.read("archive_manifest"))[0]
    assert (failed["status"], failed["warehouse_rows"]) == ("FAILED", 4)
    refresh.build_api_facts(warehouse)
    refresh.record(warehouse, folders, "api")
    assert rows(warehouse.read("archive_manifest"))[0]["status"] == "VALIDATED"
    refresh.record_kept(warehouse)
    assert rows(warehouse.read("archive_manifest"))[0]["status"] == "VALIDATED_KEPT"
    refresh.record_deleted(warehouse, logs.fingerprints(spark, folders.api).withColumn("log_type", F.lit("api")))
    gone = rows(warehouse.read("archive_manifest"))[0]
    assert gone["status"] == "DELETED" and len(gone["checksum"]) == 64


EVENTS = [{"timestamp": f"Sun, 12 Jul 2026 0{i}:00:04 AM", "event.action": f"step.{i}"} for i in range(5)]


@pytest.mark.parametrize("first", ["h1", "h2"])
@pytest.mark.parametrize("log_type", ["api", "cobrand"])
def test_one_name_in_two_folders_is_two_files(spark, folder, rows, first, log_type):
    """Whichever comes first, in batch and on the stream: nothing is skipped or overwritten, both are archived."""
    day, later = "application-2026-07-12.log", {"h1": "h2", "h2": "h1"}[first]
    lines = {"h1": EVENTS[:2], "h2": EVENTS[2:]}
    folders = refresh.LogFolders(f"{folder}/logs/*/*.log", f"{folder}/logs/*/*.log", f"{folder}/archive")
    batch, streamed = Warehouse(spark, f"{folder}/batch"), Warehouse(spark, f"{folder}/streamed")
    load, fact = {
        "api": (refresh.refresh_api, "event_fact_api"),
        "cobrand": (refresh.refresh_cobrand, "cobrand_event_fact"),
    }[log_type]
    for host in (first, later):
        write(f"{folder}/logs/{host}/{day}", lines[host])
        load(batch, f"{folder}/logs/*/*.log")
        ingest(streamed, log_type, f"{folder}/logs/*", f"{folder}/checkpoint").awaitTermination()
        refresh.archive_logs(batch, folders, log_type)
        refresh.record(batch, folders, log_type)
    want = [(f"h1/{day}", e["event.action"]) for e in EVENTS[:2]] + [(f"h2/{day}", e["event.action"]) for e in EVENTS[2:]]
    for warehouse in (batch, streamed):
        assert sorted((r["source_file"], r["event_action"]) for r in rows(warehouse.read(fact))) == sorted(want)
    state = rows(batch.read("archive_manifest"))
    assert sorted((r["source_file"], r["status"], r["json_rows"]) for r in state) == [(f"h1/{day}", "VALIDATED", 2), (f"h2/{day}", "VALIDATED", 3)]
    assert all(os.path.isdir(r["archive_path"]) for r in state)
    assert archive.read_archive(spark, folders.archive).count() == 5


def test_a_file_of_either_kind_has_its_own_audit_row(spark, folder, rows):
    for kind in ("api", "cobrand"):
        write(f"{folder}/logs/{kind}/application-2026-07-12.log", EVENTS)
    folders = refresh.LogFolders(f"{folder}/logs/api/*.log", f"{folder}/logs/cobrand/*.log", f"{folder}/archive")
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    refresh.run(warehouse, folders)
    assert [(r["log_type"], r["status"]) for r in rows(warehouse.read("archive_manifest"), "log_type", "status")] == [
        ("api", "VALIDATED"), ("cobrand", "VALIDATED")]


def test_an_empty_folder_ends_nothing(spark, folder):
    write(f"{folder}/logs/cobrand/application-2026-07-21.log", [TRACE, STANDALONE])
    folders = refresh.LogFolders(f"{folder}/logs/api/*.log", f"{folder}/logs/cobrand/*.log", f"{folder}/archive")
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    refresh.run(warehouse, folders)
    assert warehouse.read("event_fact_api").count() == 0 and warehouse.read("span_fact").count() == 4


def test_one_bad_file_does_not_end_the_load(spark, folder, rows):
    folders = standard(folder)
    for name, lines in (("good", EVENTS[:2]), ("cut", EVENTS * 500)):
        text = "\n".join(map(json.dumps, lines)).encode()
        data = gzip.compress(text)
        with open(f"{folder}/logs/api/{name}-2026-07-13.log.gz", "wb") as f:
            f.write(data if name == "good" else data[: len(data) // 2])
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    pattern = f"{folder}/logs/api/*"
    refresh.refresh_api(warehouse, pattern)
    names = {r["source_file"] for r in rows(warehouse.read("raw_api"), "source_file")}
    assert names == {"application-2026-07-12.log", "good-2026-07-13.log.gz"}
    noted = rows(Reports(warehouse).load_failures())
    assert [(r["log_type"], r["source_file"]) for r in noted] == [("api", "cut-2026-07-13.log.gz")] and noted[0]["reason"]
    with open(f"{folder}/logs/api/cut-2026-07-13.log.gz", "wb") as f:
        f.write(gzip.compress(json.dumps(EVENTS[0]).encode()))
    checksum = f"{folder}/logs/api/.cut-2026-07-13.log.gz.crc"
    assert not os.path.exists(checksum) and folders
    refresh.refresh_api(warehouse, pattern)
    assert warehouse.read("event_fact_api").where("source_file like 'cut%'").count() == 1


def test_quality_report_counts_ids_that_are_no_numbers(loaded, rows):
    found = rows(Reports(loaded[0]).api_quality())
    assert [(r["events"], r["malformed"], r["unreadable_ids"]) for r in found] == [(5, 1, 1)]


def test_inventory_of_a_damaged_table(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    warehouse.replace("event_catalog_api", spark.createDataFrame([("a.b", "a")], "event_action string, event_prefix string"))
    warehouse.replace("dim_span", warehouse.read("dim_span"))
    for part in glob.glob(f"{folder}/warehouse/event_catalog_api/version=1/*.parquet"):
        with open(part, "r+b") as f:
            f.truncate(10)
        os.remove(os.path.join(os.path.dirname(part), f".{os.path.basename(part)}.crc"))
    assert _counts(warehouse) == {"event_catalog_api": None, "dim_span": 0}


def test_undated_names_have_an_archive_path(spark, folder, rows):
    names = ["plain.log", "a-b-c.log", "odd name=1%+ü.log", "application-2026-07-12.log"]
    for name in names:
        write(f"{folder}/logs/api/{name}", EVENTS)
    folders = refresh.LogFolders(f"{folder}/logs/api/*.log", f"{folder}/logs/none/*.log", f"{folder}/archive")
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    refresh.run(warehouse, folders)
    state = rows(warehouse.read("archive_manifest"))
    assert sorted(r["source_file"] for r in state) == sorted(names)
    assert all(r["status"] == "VALIDATED" and os.path.isdir(r["archive_path"]) for r in state)
    assert sum("year=unknown/month=unknown" in r["archive_path"] for r in state) == 3
    lost = warehouse.read("archive_manifest").withColumn("archive_path", F.lit(None).cast("string"))
    assert manifest.safe_to_purge(lost).count() == 0


def test_empty_warehouse_answers_every_report(warehouse):
    report = Reports(warehouse)
    bounds = ("2026-01-01", "2026-12-31")
    assert report.kpis(*bounds).first().total_events == 0
    assert report.cobrand_health(*bounds).first().error_rate == 0.0
    assert report.coverage_kpis().first().coverage_pct == 0.0
    assert report.failure_table(*bounds).count() == 0
    assert set(REPORTS) <= set(dir(report))


def test_export_and_views(loaded, spark, folder):
    warehouse = loaded[0]
    written = {r.table: r.rows for r in warehouse.export(f"{folder}/export").collect()}
    assert written == {t: EXPECTED[t] for t in written} and len(written) == 6
    sizes = {r.table: r.bytes for r in warehouse.export(f"{folder}/export").collect()}
    assert sizes.keys() == written.keys() and all(n > 0 for n in sizes.values())
    warehouse.register_views()
    assert spark.sql("select count(*) from span_fact").first()[0] == 8
    Reports(warehouse).export_csv(warehouse.read("event_catalog_api"), f"{folder}/csv")
    assert spark.read.option("header", True).csv(f"{folder}/csv").count() == 2


def test_date_filter_prunes_partitions(loaded):
    df = Reports(loaded[0]).events_over_time("2026-07-12", "2026-07-13")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
