"""Incremental ingest as a stream: the checkpoint remembers which files were read."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from logloom.plans import refresh
from logloom.sources import logs
from logloom.sources.tables import Warehouse


def ingest(warehouse: Warehouse, log_type: str, folder: str, checkpoint: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Load all files that arrived since the last run, then stop.

    ``folder`` is a folder or a glob over folders; files are known by their path below
    it. A file is always read whole within one batch, and a batch replaces the
    partitions of its files, so a batch that is replayed after a failure changes
    nothing. Facts, shares and registries are brought up to date at the end of each batch, as a batch run does: the
    ledger says which files are new, so a batch costs its own size.
    """
    identified = log_type == "cobrand"
    text = warehouse.spark.readStream.schema(T.StructType([T.StructField("value", T.StringType())]))
    files = text.option("maxFilesPerTrigger", files_per_batch).text(folder)
    lines = logs.trimmed(files, logs.root_of(warehouse.spark, folder))

    def load(batch: DataFrame, _: int) -> None:
        warehouse.append(refresh.RAW_TABLES[log_type], logs.raw_table(batch, identified), shuffled=identified)
        with warehouse.kept(batch.select("source_file").distinct()) as arrived:
            refresh.note_loaded(warehouse, log_type, arrived)
        if identified:
            refresh.build_cobrand_facts(warehouse)
            refresh.sync_span_dimension(warehouse)
        else:
            refresh.build_api_facts(warehouse)
            refresh.sync_api_catalogs(warehouse)
        refresh.sync_gap_catalog(warehouse, log_type)

    return (
        lines.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
