import hashlib
import re

import pytest

from checks.compare import compare, duck
from logloom.llm import mixing, queries

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, weights=(5, 2, 1), epochs=3):
    """Targets by the rule as it is worded: clamp what is above, share the excess by weight, until none is above."""
    size = {}
    for source, n in rows:
        size[source] = size.get(source, 0) + n
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + ([None] if None in size else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(size), sum(size.values())
    while free:
        total = sum(weight[s] for s in free)
        above = {s for s in free if left * weight[s] / total > epochs * size[s]}
        if not above:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in above:
            target[s] = float(epochs * size[s])
            left -= target[s]
        free -= above
    return size, target


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, sf):
    assert compare(spark, duck(sf), sf, queries.op5_mixing, queries.ORACLES["op5_mixing"]) == ""


def test_targets_and_takes(spark):
    rows = [(i, s, " ".join(["w"] * n)) for i, (s, n) in enumerate(
        [("a", 3)] * 40 + [("b", 2000)] + [("z", 7)] * 300 + [("é", 50)] * 9 + [(None, 5)] * 20 + [("n", 0)] * 3
    )]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    found = mixing.mix(df).collect()
    size, target = plain([(s, len(t.split())) for _, s, t in rows])
    assert len(found) == len(rows)
    taken = {}
    for r in found:
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.repetitions * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    largest = {s: max(r.size for r in found if r.source == s) for s in size}
    for s in size:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6
    again = {(r.id, r.taken) for r in mixing.mix(df.repartition(7)).collect()}
    assert again == {(r.id, r.taken) for r in found}
    rows_taken = mixing.take(df).groupBy("doc_id").count().collect()
    assert {(r.doc_id, r["count"]) for r in rows_taken} == {(r.id, r.repetitions) for r in found if r.repetitions}


def test_another_seed_takes_others(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], "w " * (i % 9 + 1)) for i in range(400)], "doc_id long, source string, text string")
    assert {(r.id, r.taken) for r in mixing.mix(df, seed=1).collect()} != {(r.id, r.taken) for r in mixing.mix(df, seed=2).collect()}
    assert mixing._key is not None and hashlib.md5(b"1:5").hexdigest() == df.select(mixing._key(df.doc_id, 1)).collect()[5][0]


def test_odd_rows(spark, odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count()
    assert {r.id: r.size for r in rows}[1] == 0 and sum(r.taken for r in rows) > 0
    assert mixing.take(odd).columns == odd.columns
    assert mixing.mix(none).count() == 0 and mixing.take(none).count() == 0
    blank = odd.filter("doc_id in (1, 2, 3)")
    assert {(r.target, r.taken) for r in mixing.mix(blank).collect()} == {(0.0, 0)}
