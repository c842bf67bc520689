"""Whitening of vectors by a covariance in which equal vectors are counted, not repeated."""

import decimal
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import prepare, stored

#: Partial sums meet in so many groups before they meet in one.
_SLOTS = 64
_EXACT = 1 << 62


@dataclass
class Fit:
    """Of one vector length: the fit list's size, its sums per dimension, the eigenvalues and eigenvectors kept, the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    axes: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n in double precision; the whole part of the mean is taken off in integers."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exact."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = [s % self.n for s in self.sums]
        z = x - whole
        most = self.n * (int(np.abs(z).max(initial=0)) + 1)
        kind = np.int64 if most < _EXACT and most * most * max(1, x.shape[1]) < _EXACT else object
        y = z.astype(kind) * self.n - np.array(rest, kind)
        return [int(v) for v in (y * y).sum(1)]


def _matrices(column: pa.Array, kind: type) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of each length of the vectors in a column of lists."""
    lengths, values = np.diff(column.offsets.to_numpy()), column.flatten().to_numpy().astype(kind, copy=False)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, values[starts[rows][:, None] + np.arange(length)]


def quantised(vector: str | Column, scale: int, shift: int) -> tuple[Column, Column]:
    """Whether a vector takes part, and floor(scale * c) + shift of its entries as longs."""
    v = F.col(vector) if isinstance(vector, str) else vector
    limit = float(1 << 61)

    def fine(c: Column) -> Column:
        c = c.cast("double") * scale
        # NaN is above every number.
        return F.coalesce((c > -limit) & (c < limit), F.lit(False))

    return (
        F.coalesce((F.size(v) > 0) & F.forall(v, fine), F.lit(False)),
        F.transform(v, lambda c: F.floor(c.cast("double") * scale).cast("long") + shift),
    )


def _sums(distinct: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per length: the summed weights and the weighted sums of each dimension, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list[int]] = {}
        for batch in batches:
            weights = batch.column(1).to_numpy()
            for rows, x in _matrices(batch.column(0), np.int64):
                w = weights[rows]
                safe = int(np.abs(x).max()) * int(w.sum()) < _EXACT
                found = [int(w.sum()), *map(int, w @ x if safe else w.astype(object) @ x.astype(object))]
                known = total.setdefault(x.shape[1], [0] * len(found))
                total[x.shape[1]] = [a + b for a, b in zip(known, found)]
        rows = [(d, i, decimal.Decimal(v)) for d, found in total.items() for i, v in enumerate(found)]
        dims, places, values = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(dims, pa.int32()), pa.array(places, pa.int32()), pa.array(values, pa.decimal128(38, 0))], ["dim", "i", "value"]
        )

    found: dict[int, dict[int, int]] = {}
    for r in distinct.select("x", "weight").mapInArrow(run, "dim int, i int, value decimal(38,0)").groupBy("dim", "i").agg(F.sum("value").alias("v")).collect():
        found.setdefault(r.dim, {})[r.i] = int(r.v)
    return {d: (v[0], [v[i] for i in range(1, d + 1)]) for d, v in sorted(found.items())}


def _added(df: DataFrame, column: str, kind: type, rows_of) -> dict[int, np.ndarray]:
    """Sum over all vectors of the matrix that ``rows_of(length, matrix, weights)`` gives for a block of them, per length.

    A task adds up its own blocks and gives a row of the matrix per record; records meet in groups of bounded size,
    in the order of their tasks. The driver gets one matrix, whose size the vectors' length bounds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            weights = batch.column(1).to_numpy()
            for rows, x in _matrices(batch.column(0), kind):
                for at in range(0, len(rows), 4096):
                    part = rows_of(x.shape[1], x[at : at + 4096], weights[rows[at : at + 4096]].astype(np.float64))
                    total[x.shape[1]] = total.get(x.shape[1], 0) + part
        task = TaskContext.get().partitionId()
        for dim, matrix in total.items():
            size = len(matrix)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(size, dim, np.int32)),
                    pa.array(np.arange(size, dtype=np.int32)),
                    pa.array(np.full(size, task, np.int32)),
                    pa.array(list(matrix), pa.list_(pa.float64())),
                ],
                ["dim", "i", "task", "row"],
            )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("task")
        return frame.head(1)[["dim", "i", "task"]].assign(row=[np.sum(np.stack(frame["row"].to_list()), 0)])

    schema = "dim int, i int, task int, row array<double>"
    parts = df.select(column, "weight").mapInArrow(run, schema)
    some = parts.groupBy("dim", "i", (F.col("task") % _SLOTS).alias("slot")).applyInPandas(add, schema)
    found: dict[int, dict[int, list[float]]] = {}
    for r in some.groupBy("dim", "i").applyInPandas(add, schema).collect():
        found.setdefault(r.dim, {})[r.i] = r.row
    return {d: np.array([rows[i] for i in range(len(rows))]) for d, rows in found.items()}


def fit(distinct: DataFrame, components: int) -> dict[int, Fit]:
    """A fit per vector length of ``distinct(x array<long>, weight long)``: covariance with divisor n, its leading eigenvectors."""
    fits = {
        d: Fit(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0) for d, (n, sums) in _sums(distinct).items()
    }

    def scatter(dim: int, x: np.ndarray, weights: np.ndarray) -> np.ndarray:
        y = fits[dim].centred(x)
        return (y * weights[:, None]).T @ y

    for dim, matrix in _added(distinct, "x", np.int64, scatter).items():
        one = fits[dim]
        covariance = (matrix + matrix.T) / 2 / one.n
        values, axes = np.linalg.eigh(covariance)
        kept = np.argsort(-values, kind="stable")[:components]
        one.values, one.axes, one.trace = values[kept], axes[:, kept], float(np.trace(covariance))
    return fits


def _identity_error(whitened: DataFrame) -> float:
    """Largest absolute entry of the whitened vectors' own covariance minus the identity, measured; axes without variance apart."""
    sizes = _added(whitened, "y", np.float64, lambda _, y, w: np.vstack([w @ y, np.full(y.shape[1], w.sum())]))
    means = {d: m[0] / m[1] for d, m in sizes.items()}
    found = _added(whitened, "y", np.float64, lambda d, y, w: ((y - means[d]) * w[:, None]).T @ (y - means[d]))
    worst = 0.0
    for d, m in found.items():
        if d:
            worst = max(worst, float(np.abs(m / sizes[d][1][0] - np.eye(d)).max()))
    return worst


def whiten(
    df: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    components: int = 32,
    scale: int = 64,
    shift: int = 1_000_000,
    weights: str = "count",
) -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)`` for each vector that takes part and each component.

    Entries c become the longs x = floor(scale * c) + shift. Equal x-vectors are grouped; each distinct one has its number of copies as its
    weight in the fit, or one with ``weights="one"``. Mean and covariance (divisor n, the summed weights) come from passes over
    the distinct vectors, centred before they are multiplied; each distinct vector is whitened once and joined back to its
    rows. ``deviation`` is exact, as a decimal: the sum over dimensions of (n x - S)^2. ``identity_error`` is measured in
    another pass over the whitened vectors.

    Rows whose vector is null or empty, or holds a null or non-finite entry (or one whose x a long can't hold), are dropped. Vectors of
    another length have a fit of their own. Repeated ids and null ids are rows like others. Components without variance
    have a null ``whitened`` (with a single distinct vector all of them). Vectors shorter than ``components`` have fewer. An empty table gives an
    empty result. Other columns are not read. The driver holds a d x d matrix per length d, and no vector.
    """
    if weights not in ("count", "one"):
        raise ValueError("weights must be 'count' or 'one'")
    prepare(df.sparkSession)
    fine, x = quantised(vector, scale, shift)
    rows = df.filter(fine).select(F.col(vec_id).alias("id"), x.alias("x"))
    weight = F.count("*") if weights == "count" else F.lit(1)
    distinct = stored(rows.groupBy("x").agg(weight.cast("long").alias("weight")), "distinct-x")
    fits = fit(distinct, components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, deviation, found, shares = ([None] * batch.num_rows for _ in range(4))
            for at, x in _matrices(batch.column(0), np.int64):
                one = fits[x.shape[1]]
                real = one.values > 1e-12 * max(one.trace, 0.0)
                y = np.full((len(x), len(real)), np.nan)
                y[:, real] = one.centred(x) @ (one.axes[:, real] / np.sqrt(one.values[real]))
                share = (np.maximum(one.values, 0) / one.trace).tolist() if one.trace > 0 else [None] * len(real)
                for i, row, exact in zip(at, y, one.deviations(x)):
                    n[i], deviation[i], shares[i] = one.n, decimal.Decimal(exact), share
                    found[i] = [v if r else None for v, r in zip(row.tolist(), real)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(n, pa.int64()),
                    pa.array(deviation, pa.decimal128(38, 0)),
                    pa.array(found, pa.list_(pa.float64())),
                    pa.array(shares, pa.list_(pa.float64())),
                ],
                ["x", "weight", "n", "deviation", "whitened", "explained"],
            )

    schema = "x array<bigint>, weight bigint, n bigint, deviation decimal(38,0), whitened array<double>, explained array<double>"
    whitened = stored(distinct.mapInArrow(run, schema), "whitened")
    error = _identity_error(whitened.select(F.filter("whitened", lambda v: v.isNotNull()).alias("y"), "weight"))
    named = F.transform(
        "whitened",
        lambda v, i: F.struct((i + 1).alias("component"), v.alias("whitened"), F.get("explained", i).alias("explained")),
    )
    joined = rows.join(whitened.select("x", "n", "deviation", named.alias("named")), "x")
    return joined.select("id", "n", "deviation", F.inline("named")).select(
        "id", "component", "n", "deviation", "whitened", "explained", F.lit(error).alias("identity_error")
    )
