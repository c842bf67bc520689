"""Trace trees -> spans.

A trace is one row holding a tree of any depth. The tree is unfolded inside the
row, level by level, and exploded once: a single narrow pass without shuffles,
caches or driver loops, which works the same on a stream.
"""

from pyspark.sql import DataFrame, functions as F

from logloom.constants import CHILDREN_KEY, DETAIL_FIELDS, IDENTITY_FIELDS
from logloom.functions import first_member, once, parse_cobrand_time, record, subtree


def _children(node):
    """(path, parent, depth, node) of the children of one node."""
    members = F.try_variant_get(node["node"], f"$.{CHILDREN_KEY}", "array<variant>")
    return F.transform(
        F.coalesce(members, F.array().cast("array<variant>")),
        lambda child, i: F.struct(
            F.concat(node["path"], F.lit("."), i.cast("string")).alias("path"),
            node["path"].alias("parent"),
            (node["depth"] + 1).alias("depth"),
            child.alias("node"),
        ),
    )


def _next_level(levels):
    """Append the children of the deepest level; leave a finished tree alone."""
    deepest = F.element_at(levels, -1)
    return F.when(F.size(deepest) == 0, levels).otherwise(
        F.concat(levels, F.array(F.flatten(F.transform(deepest, _children))))
    )


# Levels unfolded for every trace before its real depth is looked at.
_USUAL_DEPTH = 16


def unfold(traces: DataFrame) -> DataFrame:
    """One row per node: ``path``, ``parent``, ``depth``, ``node`` next to the trace's columns and its parsed time.

    The path of the root is ``0``, that of its third child ``0.2``. Any depth is
    unfolded: a trace that is not exhausted after the usual number of levels goes
    on for as many steps as it has non-empty child lists, which no tree can exceed.
    """
    root = F.struct(
        F.lit("0").alias("path"),
        F.lit(None).cast("string").alias("parent"),
        F.lit(0).alias("depth"),
        F.col("trace").alias("node"),
    )
    usual = F.aggregate(
        F.sequence(F.lit(1), F.lit(_USUAL_DEPTH)), F.array(F.array(root)), lambda levels, _: _next_level(levels)
    )
    lists = F.regexp_count(F.to_json("trace"), F.lit(rf'"{CHILDREN_KEY}":\[[^\]]'))
    deeper = F.when(F.size(F.element_at("_levels", -1)) == 0, F.col("_levels")).otherwise(
        F.aggregate(F.sequence(F.lit(0), lists), F.col("_levels"), lambda levels, _: _next_level(levels))
    )
    traces = once(traces, {"trace_time": parse_cobrand_time("trace_timestamp")})
    nodes = traces.withColumn("_levels", usual).withColumn("_node", F.explode(F.flatten(deeper)))
    return nodes.select(*traces.columns, "_node.*")


def span_nodes(traces: DataFrame) -> DataFrame:
    """Nodes with their ids; equal input gives equal ids."""
    span_id = F.concat_ws("/", "raw_id", "path")
    parent_id = F.when(F.col("parent").isNotNull(), F.concat_ws("/", "raw_id", "parent"))
    return unfold(traces).select(
        F.col("raw_id").alias("trace_id"),
        span_id.alias("span_id"),
        parent_id.alias("parent_id"),
        "depth",
        "source_file",
        "trace_timestamp",
        "trace_time",
        "raw_id",
        "node",
    )


_NODE = {
    "timestamp": "string",
    "event.action": "string",
    "method.name": "string",
    "event.duration_ms": "double",
    "result": "map<string, string>",
    "error": "map<string, string>",
    "details": "map<string, string>",
    "attributes": "map<string, string>",
}


def span_facts(nodes: DataFrame) -> DataFrame:
    """``span_fact`` rows. Error texts come in three shapes; the first one present counts.

    A node is read in one pass; its objects become maps, in which the many keys
    that most spans lack are cheap to look for.
    """
    known = [c for c in nodes.columns if c != "node"]
    read = nodes.select(*known, record(F.col("node"), _NODE).alias("n")).withColumn("own_time", F.col("n.timestamp"))
    # Most nodes have no time of their own; that of their trace was parsed before the tree was unfolded.
    read = once(
        read,
        {"parsed_event_time": F.when(F.col("own_time").isNull(), F.col("trace_time")).otherwise(parse_cobrand_time("own_time"))},
    )
    error, details, attributes = "n.error", "n.details", "n.attributes"
    flat = read.select(
        "trace_id",
        "span_id",
        "parent_id",
        "depth",
        F.lit("cobrand").alias("source"),
        "source_file",
        F.coalesce("own_time", "trace_timestamp").alias("event_time"),
        F.col("n.`event.action`").alias("event_action"),
        F.col("n.`method.name`").alias("method_name"),
        F.col("n.`event.duration_ms`").alias("duration_ms"),
        first_member("result.status", "n.result").alias("result_status"),
        F.coalesce(
            first_member("message", error), first_member("error.message", error), first_member("error.message", details)
        ).alias("error_message"),
        F.coalesce(
            first_member("stack", error), first_member("error.stack", error), first_member("error.stack", details)
        ).alias("error_stack"),
        *[first_member(key, details, attributes, kind=kind).alias(name) for name, key, kind in IDENTITY_FIELDS],
        *[first_member(key, details, kind=kind).alias(name) for name, key, kind in DETAIL_FIELDS],
        "raw_id",
        "parsed_event_time",
    )
    return flat.withColumn("event_date", F.col("parsed_event_time").cast("date"))


def span_context(nodes: DataFrame) -> DataFrame:
    """The complete ``attributes`` and ``details`` of each span, as JSON text; ``{}`` when absent."""
    whole = {
        name: F.coalesce(F.to_json(subtree(F.col("node"), name)), F.lit("{}")).alias(name)
        for name in ("attributes", "details")
    }
    return nodes.select("span_id", whole["attributes"], whole["details"], "source_file")


def unparsed(traces: DataFrame, spans: DataFrame) -> DataFrame:
    """Traces no span was made of yet. Only roots are looked up: one key per trace."""
    done = spans.where(F.col("depth") == 0).select("raw_id")
    return traces.join(done, "raw_id", "left_anti")
