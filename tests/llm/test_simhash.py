import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from logloom.llm import queries, simhash
from logloom.llm.common import table
from logloom.llm.components import connected

SF = "/root/testdata/sf0.001"


def plain(text):
    """The fingerprint as the contract words it."""
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fingerprints, distance):
    root = list(range(len(fingerprints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fingerprints):
        for j in range(i):
            if bin(a ^ fingerprints[j]).count("1") <= distance:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(root))]


def test_query_equals_brute_force(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    rows = {r.doc_id: r for r in queries.op2_simhash(spark, SF).collect()}
    prints = [plain(r.text) for r in docs]
    roots = components(prints, 4)
    assert len(rows) == len(docs)
    for r, fingerprint, root in zip(docs, prints, roots):
        assert rows[r.doc_id].fingerprint == f"{fingerprint:016x}"
        assert rows[r.doc_id].component_id == docs[root].doc_id


@pytest.mark.parametrize("distance", [2, 3, 4, 7])
def test_links_are_all_pairs_within_the_distance(spark, distance):
    random.seed(distance)
    values = {0, (1 << 64) - 1}
    for _ in range(12):
        seed = random.getrandbits(64)
        for _ in range(12):
            values.add(seed ^ sum(1 << b for b in random.sample(range(64), random.randrange(distance + 2))))
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fingerprint long"), distance).collect()
    want = {tuple(sorted((a, b))) for a in signed for b in signed if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= distance}
    assert {tuple(r) for r in found} == want and len(found) == len(want) > 50


def test_pigeonring_never_loses_a_link():
    ring = simhash._ring(4)
    assert sum(width for _, width in ring) == 64
    random.seed(1)
    for _ in range(3000):
        x = sum(1 << b for b in random.sample(range(64), random.randrange(5)))
        bits = [bin(x >> o & (1 << w) - 1).count("1") for o, w in ring]
        viable = [s for s in range(5) if all(sum(bits[(s + k) % 5] for k in range(n)) <= n * 4 // 5 for n in range(1, 5))]
        assert viable


def test_long_texts_in_chunks(long_text):
    assert simhash.fingerprint(long_text.encode()) == plain(long_text)


def test_odd_rows(spark, odd, none):
    rows = simhash.groups(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r.id, set()).add((r.fingerprint, r.component_id))
    assert by[1] == by[2] == by[3] == {(0, 1)}
    assert len(by[5]) == 1 and {c for _, c in by[6]} == {5}
    assert by[None] != by[1]
    assert simhash.groups(none).count() == 0


def test_components_of_paths_hubs_and_nulls(spark):
    path = [(i, i + 1) for i in range(200)]
    hub = [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000), (None, 3)]
    rows = connected(spark.createDataFrame(path + hub, "a long, b long").withColumn("a", F.col("a"))).collect()
    assert {(r.node, r.root) for r in rows} == {(i, 0) for i in range(201)} | {(1000 + i, 1000) for i in range(300)}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0
