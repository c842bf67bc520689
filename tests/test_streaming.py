from pyspark.sql import functions as F

from logloom.plans import refresh
from logloom.sources.tables import Warehouse
from logloom.streaming.ingest import ingest
from logloom.streaming.windows import daily_failures
from tests.logfiles import API_DAY, STANDALONE, TRACE, write


def test_three_drops_equal_one_batch(spark, folder, rows):
    streamed, batch = Warehouse(spark, f"{folder}/streamed"), Warehouse(spark, f"{folder}/batch")
    for day in (1, 2, 3):
        write(f"{folder}/logs/cobrand-2026-07-0{day}.log", [TRACE, STANDALONE] * day)
        ingest(streamed, "cobrand", f"{folder}/logs", f"{folder}/checkpoint").awaitTermination()
    refresh.refresh_cobrand(batch, f"{folder}/logs/*.log")
    followers = ("span_shares", "gap_shares", "dim_span", "instrumentation_gap_catalog")
    for table in ("raw_cobrand", "span_fact", "span_context", "cobrand_event_fact", *followers):
        columns = [c for c in batch.read(table).columns if c not in ("doc", "discovered_at")]
        assert rows(streamed.read(table), *columns) == rows(batch.read(table), *columns)
    assert streamed.read("span_fact").count() == 6 * 4
    # One entry of each step and file: no drop did an earlier one's files again.
    entries = rows(streamed.read("file_ledger"), "step", "source_file", "rows")
    assert entries == rows(batch.read("file_ledger"), "step", "source_file", "rows") and len(entries) == 7 * 3


def test_api_drop(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    write(f"{folder}/logs/api-2026-07-01.log", API_DAY)
    for _ in range(2):
        ingest(warehouse, "api", f"{folder}/logs", f"{folder}/checkpoint").awaitTermination()
    assert warehouse.read("event_fact_api").count() == len(API_DAY)
    assert warehouse.read("event_catalog_api").count() == 2 and warehouse.read("capability_catalog").count() == 1
    assert warehouse.read("instrumentation_gap_catalog").count() == 2


def test_windowed_failures_on_a_stream(spark, folder, rows):
    schema = "parsed_event_time timestamp_ntz, level string, error_message string"
    data = [(f"2024-01-0{d} 10:00:00", "error" if i % 2 else "info", "e" if i % 3 == 0 else None) for d in (1, 2, 3) for i in range(6)]
    df = spark.createDataFrame(data, "t string, level string, error_message string")
    df.select(F.col("t").cast("timestamp_ntz").alias("parsed_event_time"), "level", "error_message").write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
    counted = daily_failures(stream, stream, late="1 day")
    run = counted.writeStream.outputMode("complete").format("memory").queryName("daily").trigger(availableNow=True)
    run.option("checkpointLocation", f"{folder}/checkpoint").start().awaitTermination()
    batch = spark.read.schema(schema).parquet(f"{folder}/in")
    assert rows(spark.table("daily")) == rows(daily_failures(batch, batch))


def test_late_rows_are_dropped_and_finished_days_come_once(spark, folder, rows):
    """Append mode: a day is emitted when the watermark has passed it; what comes later for it is not counted."""
    schema = "parsed_event_time timestamp_ntz, level string, error_message string"
    drops = [["01 10:00", "01 11:00", "02 10:00"], ["05 00:00"], ["01 12:00", "05 01:00"], ["09 00:00"], ["09 01:00"]]
    query = None
    for i, times in enumerate(drops):
        df = spark.createDataFrame([(f"2024-01-{t}:00", "error", "e") for t in times], "t string, level string, error_message string")
        df.select(F.col("t").cast("timestamp_ntz").alias("parsed_event_time"), "level", "error_message").coalesce(1).write.mode(
            "append"
        ).parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        counted = daily_failures(stream, stream.where(F.lit(False)), late="1 day")
        query = counted.writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out")
        query = query.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
    found = [(str(r["day"]), r["source"], r["count"]) for r in rows(spark.read.parquet(f"{folder}/out"))]
    assert sorted(found) == [("2024-01-01", "API", 2), ("2024-01-02", "API", 1), ("2024-01-05", "API", 2)]
