"""Near-duplicate vectors by collision counting over one-dimensional projections."""

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.common import prepare, stored
from logloom.llm.components import connected

PROJECTIONS = 16
#: Half widths of the windows, in standard deviations of the projected difference of a pair at the threshold.
_FIRST, _OTHERS = 4.0, 2.25
BLOCK = 2048


def directions(dimension: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dimension]).standard_normal((dimension, PROJECTIONS + 1))


def calibrated_count(miss: float = 1e-4) -> int:
    """The most collisions that can be asked for, of PROJECTIONS, so that a pair at the threshold is missed with chance ``miss``.

    Of a pair at the threshold each projected difference is normal, so a window of _OTHERS deviations holds it with a known
    chance, independently for each direction; closer pairs collide more often.
    """
    p = math.erf(_OTHERS / math.sqrt(2))
    below, count = 0.0, 0
    for k in range(PROJECTIONS + 1):
        below += math.comb(PROJECTIONS, k) * p**k * (1 - p) ** (PROJECTIONS - k)
        if below > miss:
            break
        count = k + 1
    return count


def _values(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors in double precision; None for null, for a null or non-finite component, and for a zero vector."""
    out: list[np.ndarray | None] = []
    for row in column:
        values = row.values
        if values is None or not len(values) or values.null_count:
            out.append(None)
            continue
        v = values.to_numpy(zero_copy_only=False).astype(np.float64)
        out.append(v if np.isfinite(v).all() and v.any() else None)
    return out


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max()  # neither overflow nor underflow in the square
    return v / np.sqrt(v @ v)


def _roots(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index that each of ``size`` points reaches over the links a-b."""
    root = np.arange(size)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def compare(left: np.ndarray, right: np.ndarray | None, cosine: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of unit vectors with at least ``cosine``: ``left`` against ``right``, or within ``left`` (each pair once).

    A pair is verified in double precision if its first projections lie in one window and enough of the others collide.
    """
    axes = directions(left.shape[1], seed)
    deviation = math.sqrt(2 - 2 * cosine)
    p = left @ axes
    q = p if right is None else right @ axes
    other = left if right is None else right
    wanted = calibrated_count()
    found_a, found_b = [], []
    order = np.argsort(q[:, 0], kind="stable")
    q, sorted_first = q[order].astype(np.float32), q[order, 0]
    for start in range(0, len(p), 256):
        part = p[start : start + 256]
        # Windows are centred at the queries: the sorted candidates between the lowest and the highest window.
        low, high = np.searchsorted(
            sorted_first, [part[:, 0].min() - _FIRST * deviation, part[:, 0].max() + _FIRST * deviation], "left"
        )
        near = q[low:high]
        if not len(near):
            continue
        part = part.astype(np.float32)
        collisions = np.zeros((len(part), len(near)), np.int8)
        for j in range(1, PROJECTIONS + 1):
            collisions += np.abs(part[:, j, None] - near[None, :, j]) <= np.float32(_OTHERS * deviation)
        hit = (collisions >= wanted) & (np.abs(part[:, 0, None] - near[None, :, 0]) <= np.float32(_FIRST * deviation))
        a, b = np.nonzero(hit)
        a, b = a + start, order[b + low]
        if right is None:
            a, b = a[a < b], b[a < b]
        for at in range(0, len(a), 1 << 15):
            i, j = a[at : at + (1 << 15)], b[at : at + (1 << 15)]
            same = np.einsum("ij,ij->i", left[i], other[j]) >= cosine
            found_a.append(i[same].astype(np.int32))
            found_b.append(j[same].astype(np.int32))
    none = np.zeros(0, np.int32)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def _described(df: DataFrame, vec_id: str, vector: str, label: str, cosine: float, seed: int) -> DataFrame:
    """``(id, label, digest, dimension, cell, vector)``; all but id and label null where the row links with nothing."""
    chosen = df.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    width = _FIRST * math.sqrt(2 - 2 * cosine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels = batch.column(0).is_null().to_pylist(), batch.column(1).is_null().to_pylist()
            rows = []
            for v, no_id, no_label in zip(_values(batch.column(2)), ids, labels):
                if v is None or no_id or no_label:
                    rows.append((None, None, None, None))
                else:
                    u = _unit(v)
                    cell = int(math.floor(float(u @ directions(len(u), seed)[:, 0]) / width))
                    rows.append((hashlib.blake2b(v.tobytes(), digest_size=16).digest(), len(v), cell, u.tobytes()))
            digest, dimension, cell, data = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(digest, pa.binary()),
                    pa.array(dimension, pa.int32()),
                    pa.array(cell, pa.int32()),
                    pa.array(data, pa.binary()),
                ],
                ["id", "label", "digest", "dimension", "cell", "vector"],
            )

    extra = [
        T.StructField("digest", T.BinaryType()),
        T.StructField("dimension", T.IntegerType()),
        T.StructField("cell", T.IntegerType()),
        T.StructField("vector", T.BinaryType()),
    ]
    return chosen.mapInArrow(run, T.StructType([chosen.schema["id"], chosen.schema["label"], *extra]))


def _paired(reps: DataFrame, block: int) -> DataFrame:
    """Each vector in every pair of blocks in which it must be compared, with its side: 0 left, 1 right, 2 both.

    Along the first projection the vectors lie in cells as wide as a window, so a pair in one window is in one cell or in two
    neighbours. Cells are dealt into blocks of about ``block`` vectors; a pair of blocks is a group of bounded size, and
    each pair of vectors meets in exactly one.
    """
    where = ["label", "dimension", "cell"]
    cells = stored(reps.groupBy(*where).agg(F.ceil(F.count("*") / block).cast("int").alias("n")), "vector-cells")
    before = cells.select("label", "dimension", (F.col("cell") + 1).alias("cell"), F.col("n").alias("n_before"))
    after = cells.select("label", "dimension", (F.col("cell") - 1).alias("cell"), F.col("n").alias("n_after"))
    around = stored(cells.join(before, where, "left").join(after, where, "left").na.fill(0, ["n_before", "n_after"]), "cell-neighbours")
    placed = reps.join(around, where).withColumn("own", F.pmod(F.xxhash64("node"), F.col("n")).cast("int"))

    def pair(cell_left, block_left, cell_right, block_right, side):
        return F.struct(
            cell_left.alias("cell_left"),
            block_left.alias("block_left"),
            cell_right.alias("cell_right"),
            block_right.alias("block_right"),
            side.cast("int").alias("side"),
        )

    def up_to(n):
        return F.filter(F.sequence(F.lit(0), n), lambda j: j < n)

    c, own = F.col("cell"), F.col("own")
    inside = F.transform(
        up_to(F.col("n")),
        lambda j: pair(c, F.least(own, j), c, F.greatest(own, j), F.when(own < j, 0).when(own > j, 1).otherwise(2)),
    )
    next_cell = F.transform(up_to(F.col("n_after")), lambda j: pair(c, own, c + 1, j, F.lit(0)))
    last_cell = F.transform(up_to(F.col("n_before")), lambda j: pair(c - 1, j, c, own, F.lit(1)))
    return placed.select("label", "dimension", "node", "n_copies", "vector", F.explode(F.concat(inside, next_cell, last_cell)).alias("p")).select(
        "label", "dimension", "node", "n_copies", "vector", "p.*"
    )


def duplicates(
    df: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = 0.98,
    seed: int = 11,
    block: int = BLOCK,
) -> DataFrame:
    """``(id, label, n_links, component_id)`` of every row: how many other rows of its label have at least ``cosine`` with it,
    and the smallest id that links reach, its own included.

    Equal vectors of a label are one point with a multiplicity. A pair of blocks gives, for each of its points, the
    number of its links and one smaller point of its class, so a dense class never becomes all of its pairs. A pair at
    the threshold is missed with a chance of about 2e-4, closer ones more rarely; no pair below the threshold is linked.

    Rows with a null id or label, and vectors that are null, empty or zero or hold a null or non-finite component, link
    with nothing: 0 links, their own id. Vectors of different dimensions never link. Rows that repeat an id count as rows of
    their own, whose links and classes stay apart where their labels or vectors differ. An empty table gives an empty result.
    """
    prepare(df.sparkSession)
    rows = stored(_described(df, vec_id, vector, label, cosine, seed), "vectors")
    folded = (
        rows.filter("digest is not null")
        .groupBy("label", "digest", "dimension", "cell")
        .agg(F.min("id").alias("least_id"), F.count("*").alias("n_copies"), F.min("vector").alias("vector"))
        # An id may stand in several labels or with several vectors: a point is known by both of these.
        .withColumn("node", F.concat_ws("/", F.hex("digest"), F.col("label").cast("string")))
    )
    reps = stored(folded, "distinct-vectors")

    def links(frame: pd.DataFrame) -> pd.DataFrame:
        within = (frame["side"] == 2).all()
        frame = frame.sort_values("side", kind="stable")
        data = np.stack([np.frombuffer(v) for v in frame["vector"]])
        cut = len(frame) if within else int((frame["side"] == 0).sum())
        a, b = compare(data[:cut], None if within else data[cut:], cosine, seed)
        b = b + (0 if within else cut)
        copies = frame["n_copies"].to_numpy()
        n_links = np.bincount(a, copies[b], len(frame)) + np.bincount(b, copies[a], len(frame))
        node = frame["node"].to_numpy()
        root = node[_roots(len(node), a, b)]
        linked = n_links > 0
        return pd.DataFrame({"node": node[linked], "n_links": n_links[linked].astype(np.int64), "root": root[linked]})

    keys = ["label", "dimension", "cell_left", "block_left", "cell_right", "block_right"]
    found = stored(_paired(reps, block).groupBy(*keys).applyInPandas(links, "node string, n_links long, root string"), "vector-links")
    degrees = found.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    classes = connected(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    joined = stored(
        reps.select("label", "digest", "node", "least_id", "n_copies").join(degrees, "node", "left").join(classes, "node", "left"),
        "vector-classes",
    )
    least = joined.filter("root is not null").groupBy("root").agg(F.min("least_id").alias("class_id"))
    nodes = joined.join(least, "root", "left").select(
        "label",
        "digest",
        (F.coalesce("n_links", F.lit(0)) + F.col("n_copies") - 1).alias("n_links"),
        F.coalesce("class_id", "least_id").alias("component_id"),
    )
    return (
        rows.select("id", "label", "digest")
        .join(nodes, ["label", "digest"], "left")
        .select("id", "label", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    )
