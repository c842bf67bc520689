import numpy as np

from logloom.llm import queries, vectors
from logloom.llm.common import table


def plain(ids, labels, data, cosine=0.98):
    """Links of every row and the smallest id it reaches, from all pairs."""
    unit = [None if v is None or not np.isfinite(v).all() or not v.any() else v / np.sqrt(v @ v) for v in data]
    n, links, root = len(ids), [0] * len(ids), list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if labels[i] is not None and labels[i] == labels[j] and unit[i] is not None and unit[j] is not None:
                if len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine:
                    links[i] += 1
                    links[j] += 1
                    x, y = find(i), find(j)
                    if ids[x] < ids[y]:
                        root[y] = x
                    else:
                        root[x] = y
    return {ids[i]: (links[i], ids[find(i)]) for i in range(n)}


def planted(seed=0):
    random = np.random.default_rng(seed)
    rows = []
    for label in range(3):
        for _ in range(12):
            centre = random.normal(size=32)
            for _ in range(random.integers(1, 12)):
                rows.append((label, centre + random.normal(size=32) * random.choice([0.0, 0.02, 0.1, 0.14, 0.2])))
    rows = [rows[i] for i in random.permutation(len(rows))]
    return [(i, label, v.tolist()) for i, (label, v) in enumerate(rows)]


SCHEMA = "vec_id long, label int, embedding array<double>"


def test_equals_all_pairs_also_in_small_blocks(spark):
    rows = planted()
    want = plain([r[0] for r in rows], [r[1] for r in rows], [np.array(r[2]) for r in rows])
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for block in (2048, 7):
        found = {r.id: (r.n_links, r.component_id) for r in vectors.duplicates(df, block=block).collect()}
        assert found == want
    assert sum(n for n, _ in want.values()) > 200


def test_query_on_given_vectors(spark):
    sf = "/root/testdata/sf0.001"
    rows = table(spark, sf, "embeddings").collect()
    want = plain([r.vec_id for r in rows], [r.label for r in rows], [np.array(r.embedding, float) for r in rows])
    found = queries.op9_vectors(spark, sf).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_recall_at_the_threshold():
    """Pairs with exactly the least cosine, the hardest ones."""
    random = np.random.default_rng(3)
    a = random.normal(size=(4000, 24))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = random.normal(size=a.shape)
    b -= (a * b).sum(1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    b = 0.9801 * a + np.sqrt(1 - 0.9801**2) * b
    i, j = vectors.compare(a, b, 0.98, 11)
    assert (i == j).sum() >= 3990
    assert 8 <= vectors.calibrated_count() < vectors.PROJECTIONS


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, 0, [1.0, 0.0]),
        (2, 0, [1.0, 0.0]),
        (2, 0, [1.0, 0.0]),
        (3, 0, [2e300, 1e299]),
        (4, 1, [1.0, 0.0]),
        (5, None, [1.0, 0.0]),
        (6, 0, None),
        (7, 0, [0.0, 0.0]),
        (8, 0, [1.0, nan]),
        (9, 0, [1.0, inf]),
        (10, 0, [1.0, None]),
        (11, 0, []),
        (12, 0, [1.0, 0.0, 0.0]),
        (None, 0, [1.0, 0.0]),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA + ", node string, digest string")
    found = {(r.id, r.n_links, r.component_id) for r in vectors.duplicates(df).collect()}
    assert found == {(1, 3, 1), (2, 3, 1), (3, 3, 1), (None, 0, None)} | {(i, 0, i) for i in range(4, 13)}
    assert vectors.duplicates(df).count() == len(rows)
    assert vectors.duplicates(df.limit(0)).count() == 0


def test_an_id_in_two_labels_or_on_two_vectors(spark):
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    rows = [(1, 0, a), (5, 0, a), (5, 1, a), (9, 1, a), (5, 0, b), (7, 0, b), (8, 0, c), (9, 0, c), (9, 0, a)]
    found = sorted((r.label, r.id, r.n_links, r.component_id) for r in vectors.duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    assert found == sorted([(0, 1, 2, 1), (0, 5, 2, 1), (0, 9, 2, 1), (1, 5, 1, 5), (1, 9, 1, 5), (0, 5, 1, 5), (0, 7, 1, 5), (0, 8, 1, 8), (0, 9, 1, 8)])
