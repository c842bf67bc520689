import json

import pytest
from pyspark.sql import functions as F

from logloom.operators import traces
from tests.logfiles import TRACE


def _traces(spark, *documents):
    data = [(f"id{i}", "f.log", json.dumps(d), "Tue, 21 Jul 2026, 00:00:47 pm") for i, d in enumerate(documents)]
    df = spark.createDataFrame(data, "raw_id string, source_file string, text string, trace_timestamp string")
    return df.select("source_file", F.parse_json("text").alias("trace"), "trace_timestamp", "raw_id")


def _spans(spark, *documents):
    return {r.span_id: r for r in traces.span_facts(traces.span_nodes(_traces(spark, *documents))).collect()}


def _chain(depth):
    node = {"event.action": f"level{depth}"}
    for level in range(depth - 1, -1, -1):
        node = {"event.action": f"level{level}", "children": [node]}
    return node


@pytest.mark.parametrize("depth", [0, 5, 15, 16, 17, 40])
def test_any_depth(spark, depth):
    spans = _spans(spark, _chain(depth))
    assert sorted(s.depth for s in spans.values()) == list(range(depth + 1))
    assert all(s.event_action == f"level{s.depth}" for s in spans.values())
    assert all(s.parent_id in spans for s in spans.values() if s.depth)


@pytest.mark.parametrize("leaf", [{}, {"children": []}, {"children": None}])
def test_leaf(spark, leaf):
    assert len(_spans(spark, {"event.action": "a", **leaf})) == 1


def test_wide_tree_keeps_order_and_parents(spark):
    document = {"event.action": "root", "children": [
        {"event.action": f"c{i}", "children": [{"event.action": f"g{i}.{j}"} for j in range(i)]} for i in range(12)]}
    spans = _spans(spark, document)
    assert len(spans) == 1 + 12 + sum(range(12))
    assert spans["id0/0.11.3"].event_action == "g11.3"
    assert spans["id0/0.11.3"].parent_id == "id0/0.11"
    assert spans["id0/0"].parent_id is None


def test_three_error_shapes_and_their_order(spark):
    both = {"error": {"message": "first", "error.message": "second"}, "details": {"error.message": "third"}}
    text = {"error": "not an object", "details": {"error.message": "third"}}
    spans = _spans(spark, TRACE["trace.method"], both, text)
    assert spans["id0/0"].error_message == "in details"
    assert (spans["id0/0.0"].error_message, spans["id0/0.0"].error_stack) == ("plain", "s")
    assert spans["id0/0.1"].error_message == "dotted"
    assert spans["id1/0"].error_message == "first"
    assert spans["id2/0"].error_message == "third"


def test_identity_lifting_and_times(spark):
    spans = _spans(spark, TRACE["trace.method"])
    root, upload = spans["id0/0"], spans["id0/0.0.0"]
    assert (root.request_id, root.user_id, root.result_status, root.duration_ms) == ("r1", 7, "failed", 100.0)
    assert (upload.queue_remaining, upload.callback_completed, upload.user_id) == (4, True, None)
    assert str(root.parsed_event_time) == "2026-07-21 12:00:47"
    assert str(upload.parsed_event_time) == "2026-07-21 01:00:00"


def test_context_keeps_everything(spark, rows):
    context = {r["span_id"]: r for r in rows(traces.span_context(traces.span_nodes(_traces(spark, TRACE["trace.method"]))))}
    assert json.loads(context["id0/0"]["details"]) == TRACE["trace.method"]["details"]
    assert context["id0/0.1"]["details"] == context["id0/0.1"]["attributes"] == "{}"


def test_only_unparsed_traces_are_left(spark):
    every = _traces(spark, {"event.action": "a"}, {"event.action": "b"})
    spans = traces.span_facts(traces.span_nodes(every.where("raw_id = 'id0'")))
    assert [r.raw_id for r in traces.unparsed(every, spans).collect()] == ["id1"]


def test_unfolding_needs_no_shuffle(spark):
    plan = traces.span_facts(traces.span_nodes(_traces(spark, TRACE["trace.method"])))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
