import math

import numpy as np
import pytest
from pyspark.sql import types as T

from __spark_entry__ import queries
from logloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n string, dim string, weight string"


def frame(spark, vectors, ids=None):
    ids = ids if ids is not None else range(len(vectors))
    return spark.createDataFrame([(i, v, 0, "x", "x", "x", "x") for i, v in zip(ids, vectors)], SCHEMA).repartition(3)


def plain(vectors, scale=64):
    """The same by a covariance over all rows, copies repeated."""
    x = np.floor(scale * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    y = (x * n - sums) / n
    covariance = y.T @ y / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    return n, (x * n - sums) ** 2, y @ axes / np.sqrt(np.abs(values)), values / np.trace(covariance)


def by_row(rows, k):
    found = {}
    for r in rows:
        found.setdefault(r.id, {})[r.component] = r
    return {i: [c[j] for j in range(1, k + 1)] for i, c in found.items()}


@pytest.fixture(scope="module")
def drawn():
    rng = np.random.default_rng(3)
    some = rng.normal(size=(300, 6)) * [3, 2, 1.5, 1, 0.7, 0.4]
    # A third of all rows is one vector, others repeat as well.
    return [v.tolist() for v in np.vstack([some, np.repeat(some[:1], 200, 0), np.repeat(some[5:9], 7, 0)])]


def test_equals_whitening_of_every_row(spark, drawn):
    rows = whitening.whiten(frame(spark, drawn), components=4).collect()
    n, deviation, whitened, explained = plain(drawn)
    found = by_row(rows, 4)
    assert len(found) == n and len(rows) == 4 * n
    got = np.array([[c.whitened for c in found[i]] for i in range(n)])
    signs = np.sign((got * whitened[:, :4]).sum(0))
    assert np.abs(got - whitened[:, :4] * signs).max() < 1e-9
    assert all(int(found[i][0].deviation) == deviation[i].sum() and found[i][0].n == n for i in range(n))
    assert np.allclose([c.explained for c in found[0]], explained[:4], rtol=1e-9)
    assert 0 <= rows[0].identity_error < 1e-9 and len({r.identity_error for r in rows}) == 1


def test_each_distinct_vector_may_weigh_one(spark, drawn):
    distinct = list(map(list, {tuple(np.floor(64 * np.float32(v))): v for v in drawn}.values()))
    ones = by_row(whitening.whiten(frame(spark, drawn), components=3, weights="one").collect(), 3)
    alone = by_row(whitening.whiten(frame(spark, distinct), components=3).collect(), 3)
    assert ones[0][0].n == len(distinct)
    first = [i for i, v in enumerate(drawn) if v == distinct[0]][0]
    assert np.allclose(np.abs([c.whitened for c in ones[first]]), np.abs([c.whitened for c in alone[0]]), atol=1e-9)


def test_odd_rows(spark):
    v = [[1.0, 2.0], [2.0, 1.0], [0.5, -1.0], None, [], [1.0, None], [math.nan, 1.0], [math.inf, 1.0], [3e38, 0.0], [1.0, 2.0]]
    rows = whitening.whiten(frame(spark, v, [1, 2, None, 4, 5, 6, 7, 8, 9, 1])).collect()
    assert sorted((str(r.id), r.component) for r in rows) == sorted((i, c) for i in ("1", "1", "2", "None") for c in (1, 2))
    assert all(r.n == 4 for r in rows)


def test_no_variance_no_rows_and_other_lengths(spark):
    alone = whitening.whiten(frame(spark, [[1.0, 2.0]] * 3)).collect()
    assert len(alone) == 6 and all(r.whitened is None and r.deviation == 0 for r in alone)
    assert whitening.whiten(frame(spark, [[1.0]]).limit(0)).count() == 0
    mixed = whitening.whiten(frame(spark, [[1.0, 0.0], [0.0, 1.0], [1.0], [2.0], [4.0]])).collect()
    assert sorted((r.id, r.component, r.n) for r in mixed) == [(0, 1, 2), (0, 2, 2), (1, 1, 2), (1, 2, 2), (2, 1, 3), (3, 1, 3), (4, 1, 3)]
    with pytest.raises(ValueError):
        whitening.whiten(frame(spark, [[1.0]]), weights="other")


def test_exact_beyond_longs():
    fit = whitening.Fit(3, [7, 3 * 10**15], np.zeros(0), np.zeros((2, 0)), 0.0)
    x = np.array([[10**17, 5], [1, 10**15]])
    assert fit.deviations(x) == [sum((3 * int(c) - s) ** 2 for c, s in zip(row, fit.sums)) for row in x]


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    found = queries()["op11_whitening"](spark, sf_dir)
    assert [f.dataType for f in found.schema.fields[1:4]] == [T.IntegerType(), T.LongType(), T.LongType()]
    rows = found.collect()
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    vectors = [r.embedding for r in given]
    n, deviation, whitened, explained = plain(vectors)
    place = {r.vec_id: i for i, r in enumerate(given)}
    assert len(rows) == 32 * n and all(r.deviation == deviation[place[r.vec_id]].sum() == r.deviation_exact for r in rows)
    got = np.zeros((n, 32))
    for r in rows:
        got[place[r.vec_id], r.component - 1] = r.whitened
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
    signs = np.sign((got * whitened[:, :32]).sum(0))
    assert np.abs(got - whitened[:, :32] * signs).max() < 1e-6
