"""The daily refresh: load, catalog, archive, validate, record.

Each step reads what the step before it stored and works on new files only, so a
run that died is continued by simply running again.
"""

from dataclasses import dataclass
from typing import NamedTuple

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, functions as F

from logloom.constants import DELETED, FAILED, VALIDATED, VALIDATED_KEPT
from logloom.operators import archive, catalogs, flatten, gaps, manifest, traces
from logloom.operators.upsert import upsert
from logloom.sources import ledger, logs
from logloom.sources.tables import Warehouse

# What differs between the two kinds of log.
RAW_TABLES = {"api": "raw_api", "cobrand": "raw_cobrand"}
FACTS = {"api": ("event_fact_api",), "cobrand": ("cobrand_event_fact", "span_fact")}


@dataclass(frozen=True)
class LogFolders:
    """Where the logs lie (globs) and where their archive goes."""

    api: str
    cobrand: str
    archive: str

    def of(self, log_type: str) -> str:
        return getattr(self, log_type)


class Loaded(NamedTuple):
    """Numbers of files that a load stored, and that it could not read."""

    loaded: int
    failed: int


def load_raw(warehouse: Warehouse, log_type: str, pattern: str) -> Loaded:
    """Read the log files that the ledger doesn't know into the raw table. The text is scanned once.

    The new files are stored as a table and loaded in rounds; a round's paths are all that the driver lists. If a
    round fails, the files that can't be read are looked for and noted in ``load_failures``, and the others are
    loaded; the next refresh tries the noted ones again. A failure that no file explains is raised.
    """
    table, spark = RAW_TABLES[log_type], warehouse.spark
    root, first = logs.root_of(spark, pattern), warehouse.next_batch()
    loaded = failed = 0
    with warehouse.kept(ledger.unknown(warehouse.read("file_ledger"), table, logs.list_files(spark, pattern))) as fresh:
        while True:
            tried = warehouse.read("file_ledger").where((F.col("step") == table) & (F.col("batch") >= first))
            rest = fresh.join(tried.select("source_file"), "source_file", "left_anti")
            files = rest.orderBy("source_file").limit(ledger.FILES_PER_ROUND).collect()
            if not files:
                return Loaded(loaded, failed)
            bad = _load_round(warehouse, log_type, [f.path for f in files], root)
            good = [f for f in files if f.path not in bad]
            if good:
                note_loaded(warehouse, log_type, spark.createDataFrame(good, rest.schema))
            if bad:
                unread = spark.createDataFrame([(f.source_file, bad[f.path]) for f in files if f.path in bad], "source_file string, reason string")
                note_failures(warehouse, log_type, unread)
                warehouse.note(table, unread)
            loaded, failed = loaded + len(good), failed + len(bad)


def _load_round(warehouse: Warehouse, log_type: str, paths: list[str], root: str) -> dict[str, str]:
    """Load some files; returns those that can't be read, with the reason."""
    table, identified = RAW_TABLES[log_type], log_type == "cobrand"

    def load(chosen: list[str]) -> None:
        if chosen:
            warehouse.append(table, logs.raw_table(logs.scan_lines(warehouse.spark, chosen, root), identified), shuffled=identified)

    try:
        load(paths)
        return {}
    except (PySparkException, Py4JError):
        bad = dict(logs.unreadable_files(warehouse.spark, paths))
        if not bad:
            raise
        load([p for p in paths if p not in bad])
        return bad


def note_loaded(warehouse: Warehouse, log_type: str, files: DataFrame) -> None:
    """Enter files whose lines were just stored; only their own partitions are counted."""
    table = RAW_TABLES[log_type]
    warehouse.note(table, files, archive.count_per_file(_only(warehouse.read(table), files)))


def note_failures(warehouse: Warehouse, log_type: str, failures: DataFrame) -> None:
    """Keep the newest reason of each file (``source_file``, ``reason``) that couldn't be loaded."""
    noted = failures.select(F.lit(log_type).alias("log_type"), "source_file", "reason", F.localtimestamp().alias("failed_at"))
    keys = ("log_type", "source_file")
    warehouse.replace("load_failures", upsert(warehouse.read("load_failures"), noted, keys, ("reason", "failed_at")))


def _only(df: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of some files, at most a round's. Their names are partition values, so no other file is opened.

    The condition on the name, true of any, is what lets Spark prune partitions by the broadcast names.
    """
    names = files.where(F.length("source_file") > 0).select("source_file")
    return df.join(F.broadcast(names), "source_file", "left_semi")


def _advance(warehouse: Warehouse, source: str, target: str, build, stored=None) -> None:
    """Do a step for the files that the step ``source`` has stored and ``target`` has not, in rounds.

    ``build(files)`` writes the rows of a round's files and ``stored(files)`` counts them again as they were written.
    Without ``stored`` the step makes registries, which follow from shares of all files: one round for any number.
    """
    while True:
        files = ledger.pending(warehouse.read("file_ledger"), source, target)
        if stored is not None:
            files = files.orderBy("source_file").limit(ledger.FILES_PER_ROUND)
        with warehouse.kept(files) as chosen:
            if chosen.isEmpty():
                return
            build(chosen)
            nothing = warehouse.spark.createDataFrame([], "source_file string, rows bigint")
            warehouse.note(target, chosen, nothing if stored is None else stored(chosen))


def _rows_of(warehouse: Warehouse, table: str, condition: Column | None = None):
    """Counts the rows that a table has of a round's files."""

    def count(files: DataFrame) -> DataFrame:
        rows = warehouse.read(table)
        return archive.count_per_file(_only(rows if condition is None else rows.where(condition), files))

    return count


def build_api_facts(warehouse: Warehouse) -> None:
    def build(files: DataFrame) -> None:
        raw = warehouse.read("raw_api").where(F.col("kind") != logs.MALFORMED)
        warehouse.append("event_fact_api", flatten.flatten_api(logs.documents(_only(raw, files))))

    _advance(warehouse, "raw_api", "event_fact_api", build, _rows_of(warehouse, "event_fact_api"))


def build_cobrand_facts(warehouse: Warehouse) -> None:
    def build_events(files: DataFrame) -> None:
        events = _only(warehouse.read("raw_cobrand").where(F.col("kind") == logs.EVENT), files)
        warehouse.append("cobrand_event_fact", flatten.flatten_standalone(logs.standalone(events)))

    def build_spans(files: DataFrame) -> None:
        traced = _only(warehouse.read("raw_cobrand").where(F.col("kind") == logs.TRACE), files)
        nodes = traces.span_nodes(logs.traces(traced))
        warehouse.append("span_context", traces.span_context(nodes))
        warehouse.append("span_fact", traces.span_facts(nodes))

    _advance(warehouse, "raw_cobrand", "cobrand_event_fact", build_events, _rows_of(warehouse, "cobrand_event_fact"))
    _advance(warehouse, "raw_cobrand", "span_fact", build_spans, _rows_of(warehouse, "span_fact", F.col("depth") == 0))


def _folded(shares: DataFrame, count: str) -> DataFrame:
    """Rows per file that its stored shares stand for."""
    return shares.groupBy("source_file").agg(F.sum(count).alias("rows"))


def fold_events(warehouse: Warehouse) -> None:
    """Add the shares of new files to ``event_shares``."""

    def build(files: DataFrame) -> None:
        events = _only(warehouse.read("event_fact_api"), files)
        warehouse.append("event_shares", catalogs.fold_events(events, "source_file"), shuffled=True)

    _advance(warehouse, "event_fact_api", "event_shares", build, lambda files: _folded(_only(warehouse.read("event_shares"), files), "event_count"))


# log type -> (its fact, the messages of the fact that name no event)
GAP_SOURCES = {"api": ("event_fact_api", gaps.api_gap_source), "cobrand": ("cobrand_event_fact", gaps.cobrand_gap_source)}


def _gap_shares(warehouse: Warehouse, log_type: str) -> DataFrame:
    return warehouse.read("gap_shares").where(F.col("source_system") == log_type.upper())


def fold_gaps(warehouse: Warehouse, log_type: str) -> None:
    """Add the shares of new files to ``gap_shares``."""
    fact, source = GAP_SOURCES[log_type]

    def build(files: DataFrame) -> None:
        fresh = _only(warehouse.read(fact), files)
        folded = gaps.fold_gaps(source(fresh, "source_file"))
        rest = gaps.no_gaps(fresh, log_type.upper())
        warehouse.append("gap_shares", folded.unionByName(rest, allowMissingColumns=True), shuffled=True)

    def stored(files: DataFrame) -> DataFrame:
        return _folded(_only(_gap_shares(warehouse, log_type), files), "occurrence_count")

    _advance(warehouse, fact, f"gap_shares_{log_type}", build, stored)


def sync_api_catalogs(warehouse: Warehouse) -> None:
    """Event catalog and registry from the stored shares, where any are new; the fact's history is not read."""
    fold_events(warehouse)

    def build(_: DataFrame) -> None:
        shares = warehouse.read("event_shares")
        warehouse.replace("event_catalog_api", catalogs.event_catalog(shares))
        registry = catalogs.sync_capabilities(warehouse.read("capability_catalog"), catalogs.capability_totals(shares))
        warehouse.replace("capability_catalog", registry)

    _advance(warehouse, "event_shares", "event_catalog_api", build)


def sync_gap_catalog(warehouse: Warehouse, log_type: str) -> None:
    """Gap catalog from the stored shares of both sources, where any are new."""
    fold_gaps(warehouse, log_type)

    def build(_: DataFrame) -> None:
        current = warehouse.read("instrumentation_gap_catalog")
        metadata = gaps.gap_totals(warehouse.read("gap_shares"))
        warehouse.replace("instrumentation_gap_catalog", gaps.sync_gaps(current, metadata))

    _advance(warehouse, f"gap_shares_{log_type}", f"instrumentation_gap_catalog_{log_type}", build)


def fold_spans(warehouse: Warehouse) -> None:
    """Add the shares of new files to ``span_shares``."""

    def build(files: DataFrame) -> None:
        spans = _only(warehouse.read("span_fact"), files)
        warehouse.append("span_shares", catalogs.fold_spans(spans, "source_file"), shuffled=True)

    _advance(warehouse, "span_fact", "span_shares", build, lambda files: _folded(_only(warehouse.read("span_shares"), files), "span_count"))


def sync_span_dimension(warehouse: Warehouse, now=None) -> None:
    """Span dimension from the stored shares, where any are new; the spans of files that were folded before are not read."""
    fold_spans(warehouse)

    def build(_: DataFrame) -> None:
        dimension = catalogs.merge_dimension(warehouse.read("span_shares"), warehouse.read("dim_span"), now)
        warehouse.replace("dim_span", dimension)

    _advance(warehouse, "span_shares", "dim_span", build)


def audit(warehouse: Warehouse) -> DataFrame:
    """Hold the ledger against the tables, by counts per partition value; returns the entries that this added.

    A file whose rows in a table are not those of the step before, or of its own raw entry, loses its entry, so the next
    refresh stores it again. A warehouse older than its ledger gets its entries this way.
    """
    first = warehouse.next_batch()
    read, count = warehouse.read, archive.count_per_file
    for table in RAW_TABLES.values():
        book, have = read("file_ledger"), count(read(table))
        # What the load entered is right, what it didn't enter is taken as found. An unread file stays unread.
        found = have.join(ledger.done(book, table), "source_file", "left_anti")
        want = ledger.done(book, table).select("source_file", "rows").unionByName(found)
        wrong = ledger.corrections(book, table, want, have)
        warehouse.enter(table, wrong.join(want, "source_file", "left_semi"))
    kind = F.col("kind")
    steps = {
        "event_fact_api": (lambda: count(read("raw_api").where(kind != logs.MALFORMED)), lambda: count(read("event_fact_api"))),
        "cobrand_event_fact": (lambda: count(read("raw_cobrand").where(kind == logs.EVENT)), lambda: count(read("cobrand_event_fact"))),
        "span_fact": (
            lambda: count(read("raw_cobrand").where(kind == logs.TRACE)),
            lambda: count(read("span_fact").where(F.col("depth") == 0)),
        ),
        "event_shares": (lambda: count(read("event_fact_api")), lambda: _folded(read("event_shares"), "event_count")),
        "gap_shares_api": (lambda: count(read("event_fact_api")), lambda: _folded(_gap_shares(warehouse, "api"), "occurrence_count")),
        "gap_shares_cobrand": (
            lambda: count(read("cobrand_event_fact")),
            lambda: _folded(_gap_shares(warehouse, "cobrand"), "occurrence_count"),
        ),
        "span_shares": (lambda: count(read("span_fact")), lambda: _folded(read("span_shares"), "span_count")),
    }
    for step, (want, have) in steps.items():
        warehouse.enter(step, ledger.corrections(read("file_ledger"), step, want(), have()))
    return read("file_ledger").where(F.col("batch") >= first)


def refresh_api(warehouse: Warehouse, pattern: str) -> Loaded:
    """Load new API logs and bring fact and catalogs up to date."""
    outcome = load_raw(warehouse, "api", pattern)
    build_api_facts(warehouse)
    sync_api_catalogs(warehouse)
    sync_gap_catalog(warehouse, "api")
    return outcome


def refresh_cobrand(warehouse: Warehouse, pattern: str, now=None) -> Loaded:
    """Load new Cobrand logs and bring facts, catalog and dimension up to date."""
    outcome = load_raw(warehouse, "cobrand", pattern)
    build_cobrand_facts(warehouse)
    sync_gap_catalog(warehouse, "cobrand")
    sync_span_dimension(warehouse, now)
    return outcome


# --- archive and audit -------------------------------------------------------------------


def _archived(warehouse: Warehouse, root: str, log_type: str) -> DataFrame:
    """Readable archive rows per file; an unreadable file simply counts less."""
    if not warehouse.has(root):
        return warehouse.spark.createDataFrame([], "source_file string, rows bigint")
    rows = archive.read_archive(warehouse.spark, root, tolerant=True).where(F.col("log_type") == log_type)
    return archive.count_per_file(rows)


def archive_logs(warehouse: Warehouse, folders: LogFolders, log_type: str) -> None:
    """Archive the files that have no complete archive: new ones and damaged ones.

    The raw table says how many good lines a file has, so only the names of files
    that need work are collected, and only those logs are read again.
    """
    expected = archive.count_per_file(warehouse.read(RAW_TABLES[log_type]).where(F.col("kind") != logs.MALFORMED))
    todo = expected.join(_archived(warehouse, folders.archive, log_type), ["source_file", "rows"], "left_anti")
    files = logs.list_files(warehouse.spark, folders.of(log_type)).join(todo, "source_file", "left_semi")
    paths = [row.path for row in files.select("path").collect()]
    if paths:
        root = logs.root_of(warehouse.spark, folders.of(log_type))
        checked = logs.parse_lines(logs.scan_lines(warehouse.spark, paths, root))
        archive.write_archive(archive.archive_rows(checked, log_type), folders.archive)


def reconcile(warehouse: Warehouse, folders: LogFolders, log_type: str) -> DataFrame:
    """The three counts of every log file that has not been settled yet."""
    spark = warehouse.spark
    of_type = warehouse.read("archive_manifest").where(F.col("log_type") == log_type)
    settled = of_type.where(F.col("status").isin(VALIDATED, VALIDATED_KEPT, DELETED))
    files = logs.list_files(spark, folders.of(log_type)).join(settled, "source_file", "left_anti")
    found = {row.source_file: row.path for row in files.select("source_file", "path").collect()}
    if not found:
        nothing = spark.createDataFrame([], "source_file string, rows bigint")
        return archive.reconcile(nothing, nothing, nothing)
    lines = logs.parse_lines(logs.scan_lines(spark, list(found.values()), logs.root_of(spark, folders.of(log_type))))
    of_files = F.col("source_file").isin(list(found))
    if log_type == "api":
        loaded = (warehouse.read("event_fact_api").where(of_files),)
    else:
        raw = warehouse.read("raw_cobrand").where(of_files)
        loaded = (raw.where(F.col("kind") == logs.TRACE), warehouse.read("cobrand_event_fact").where(of_files))
    return archive.reconcile(
        archive.count_per_file(lines.where(F.col("kind") != logs.MALFORMED)),
        archive.count_per_file(*loaded),
        _archived(warehouse, folders.archive, log_type).where(of_files),
    )


def record(warehouse: Warehouse, folders: LogFolders, log_type: str, now=None) -> None:
    """Write archived and validated (or failed) files into the manifest.

    A file whose rows are not all in the warehouse loses its ledger entries, so that its facts are built again.
    """
    counts = reconcile(warehouse, folders, log_type).withColumn("log_type", F.lit(log_type))
    archived = counts.where(F.col("parquet_rows") > 0).select(
        "source_file",
        "log_type",
        archive.partition_path(folders.archive, log_type).alias("archive_path"),
    )
    state = manifest.record_archived(warehouse.read("archive_manifest"), archived, now)
    warehouse.replace("archive_manifest", manifest.record_validation(state, counts, now))
    short = (F.col("log_type") == log_type) & (F.col("status") == FAILED) & (F.col("warehouse_rows") != F.col("json_rows"))
    files = warehouse.read("archive_manifest").where(short)
    if not files.isEmpty():
        for step in FACTS[log_type]:
            warehouse.note(step, files.select("source_file"))


def record_kept(warehouse: Warehouse, notes: str | None = None) -> None:
    """Mark all validated files as kept on purpose."""
    current = warehouse.read("archive_manifest")
    args = (notes,) if notes else ()
    warehouse.replace("archive_manifest", manifest.record_kept(current, manifest.safe_to_purge(current), *args))


def record_deleted(warehouse: Warehouse, files: DataFrame, now=None) -> None:
    """Note that ``files`` (``log_type``, ``source_file``, ``checksum``) were removed by whoever owns them."""
    warehouse.replace("archive_manifest", manifest.record_deleted(warehouse.read("archive_manifest"), files, now))


def run(warehouse: Warehouse, folders: LogFolders, now=None) -> dict[str, Loaded]:
    """The whole refresh; returns the outcome of each load. Log files are never deleted; see ``manifest.safe_to_purge``."""
    outcome = {"api": refresh_api(warehouse, folders.api), "cobrand": refresh_cobrand(warehouse, folders.cobrand, now)}
    for log_type in RAW_TABLES:
        archive_logs(warehouse, folders, log_type)
        record(warehouse, folders, log_type, now)
    return outcome
