"""Quality classifier: Naive Bayes support vectors over hashed n-grams of bytes and words, fitted by dual coordinate descent."""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.common import blocks, prepare

DIMENSIONS = 1 << 16
ORDERS = (1, 2, 3, 4)
_ROWS, _SIZE = 32, 1 << 20


class Model(NamedTuple):
    """score = 1 / (1 + exp(-(slope * margin + offset))), margin = weights . indicators / norm + bias."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float


def indicators(texts: list[bytes | None]) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(first row, last row + 1, row * DIMENSIONS + bucket of every n-gram in it, once, ascending)`` by blocks.

    Whole texts: one longer than a block is read in pieces that overlap by an n-gram, and its words are carried from piece
    to piece, so that it has the indicators that it would have in one piece.
    """
    for start, stop in blocks(texts, _ROWS, _SIZE):
        rows = stop - start
        seen = np.zeros((rows + 1) * DIMENSIONS, bool)  # the last row takes what would reach into the next text
        if rows == 1:
            whole = texts[start] or b""
            step = _SIZE - max(ORDERS) + 1
            for at in range(0, max(len(whole), 1), step):
                _mark(seen, [whole[at : at + _SIZE]], rows)
            _mark_long_repeats(seen, whole)
        else:
            data, base = _mark(seen, [t or b"" for t in texts[start:stop]], rows)
            starts, words = _words(data, base)
            _mark_repeats(seen, words, base[starts])
        yield start, stop, np.flatnonzero(seen[: rows * DIMENSIONS])


def _mark(seen: np.ndarray, texts: list[bytes], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Mark the byte n-grams; returns the texts' bytes and the first place of each byte's row."""
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint32)
    lengths = np.array([len(t) for t in texts])
    base = np.repeat(np.arange(len(texts), dtype=np.int32) * DIMENSIONS, lengths)
    ends = np.cumsum(lengths)
    code = data
    for order in range(1, max(ORDERS) + 1):
        if order > 1:
            if len(code) < 2:
                break
            code = code[:-1] | data[order - 1 :] << np.uint32(8 * (order - 1))
        if order in ORDERS:
            bucket = (code * np.uint32(2654435761) + np.uint32(order * 0x9E3779B1 % 2**32)) >> np.uint32(16)
            place = base[: len(code)].copy()
            for k in range(1, order):
                over = ends - k
                place[over[(over >= 0) & (over < len(code))]] = rows * DIMENSIONS
            seen[place + bucket.astype(np.int32)] = True
    return data, base


def _spaces(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def _words(data: np.ndarray, base: np.ndarray, own: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word in the first ``own`` bytes. A hash is a sum over a word's pairs of bytes, so parts of a word add up."""
    own = len(data) if own is None else own
    space = _spaces(data)
    first = ~space
    first[1:] &= space[:-1] | (base[1:] != base[:-1])
    starts = np.flatnonzero(first[:own])
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    byte = np.where(space, np.uint32(0), data)
    pair = byte.copy()
    pair[:-1] |= np.where(base[1:] == base[:-1], byte[1:], np.uint32(0)) << np.uint32(8)
    pair *= np.uint32(2246822519)
    pair ^= pair >> np.uint32(15)
    return starts, np.add.reduceat(np.where(space, np.uint32(0), pair)[:own], starts, dtype=np.uint64)


def _mark_repeats(seen: np.ndarray, words: np.ndarray, row: np.ndarray) -> None:
    """Indicators of word n-grams that are one word n times over: n = 2, 3, 5 and 9, a bucket each."""
    same = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    for level in range(4):
        seen[row[: len(same)][same] + (DIMENSIONS - 1 - level)] = True
        gap = 1 << level
        if len(same) <= gap:
            return
        same = same[gap:] & same[:-gap]


def _mark_long_repeats(seen: np.ndarray, text: bytes) -> None:
    """The same for one text, piece by piece. Eight words, and one that the piece's end may cut, go on into the next piece."""
    known, inside = np.zeros(0, np.uint64), False
    for at in range(0, len(text), _SIZE):
        data = np.frombuffer(text[at : at + _SIZE + 1], np.uint8).astype(np.uint32)  # the last byte is only looked at
        own = min(_SIZE, len(data))
        space = _spaces(data)
        _, words = _words(data, np.zeros(len(data), np.int32), own)
        if inside and not space[0]:
            known[-1] += words[0]
            words = words[1:]
        known = np.concatenate([known, words])
        inside = not space[own - 1]
        done = known[:-1] if inside and at + _SIZE < len(text) else known
        _mark_repeats(seen, done, np.zeros(len(done), np.int32))
        known = known[-9:].copy()


def descend(index: list[np.ndarray], signs: np.ndarray, ratios: np.ndarray, cost: float, epochs: int, seed: int):
    """Weights and bias of min |w|^2 / 2 + cost * sum(hinge), one coordinate of the dual at a time, in seeded orders."""
    # Values are taken from the ratios when a row's turn comes; only the buckets of the sample are held.
    squares = ratios**2
    norms = np.array([max(np.sqrt(squares[i].sum()), 1e-6) for i in index])
    weights, bias, alpha = np.zeros(DIMENSIONS), 0.0, np.zeros(len(index))
    curvature = np.array([squares[i].sum() / n**2 + 1.0 for i, n in zip(index, norms)])
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in order.permutation(len(index)):
            values = ratios[index[i]] / norms[i]
            gradient = signs[i] * (weights[index[i]] @ values + bias) - 1.0
            moved = min(max(alpha[i] - gradient / curvature[i], 0.0), cost)
            step = (moved - alpha[i]) * signs[i]
            if step:
                weights[index[i]] += step * values
                bias += step
                alpha[i] = moved
                worst = max(worst, abs(step))
        if worst < 1e-3 * cost:
            break
    return weights, bias


def _calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over margins, by Newton steps on smoothed targets."""
    ones = labels.sum()
    target = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        d, h = p - target, np.maximum(p * (1 - p), 1e-9)
        g = np.array([d @ margins, d.sum()])
        hess = np.array([[h @ (margins * margins) + 1e-6, h @ margins], [h @ margins, h.sum() + 1e-6]])
        step = np.linalg.solve(hess, g)
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(max(slope, 1e-3)), float(offset)


def fit_rows(index: list[np.ndarray], labels: np.ndarray, smoothing: float, cost: float, epochs: int, seed: int) -> Model:
    """The model of some labelled rows. With one class only, or no row, every text gets the smoothed share of label 1."""
    ones = int(labels.sum())
    if ones in (0, len(labels)):
        share = (ones + 1) / (len(labels) + 2)
        none = np.zeros(DIMENSIONS)
        return Model(none, none, 0.0, 1.0, float(np.log(share / (1 - share))))
    counts = np.full((2, DIMENSIONS), smoothing)
    for i, label in zip(index, labels):
        counts[label, i] += 1
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    # A fifth of the rows is kept from the descent, to calibrate on margins it has not seen.
    apart = np.arange(len(labels)) % 5 == 4
    if len(set(labels[apart])) < 2 or len(set(labels[~apart])) < 2:
        apart[:] = False
    chosen = np.flatnonzero(~apart)
    weights, bias = descend([index[i] for i in chosen], labels[chosen] * 2.0 - 1, ratios, cost, epochs, seed)
    watch = np.flatnonzero(apart) if apart.any() else chosen
    margins = np.array([_margin(index[i], ratios, weights, bias) for i in watch])
    return Model(ratios, weights, bias, *_calibrate(margins, labels[watch]))


def _margin(index: np.ndarray, ratios: np.ndarray, weights: np.ndarray, bias: float) -> float:
    v = ratios[index]
    return float(weights[index] @ v / max(np.sqrt(v @ v), 1e-6) + bias)


def fit(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = 8192,
    smoothing: float = 1.0,
    cost: float = 1.0,
    epochs: int = 20,
    seed: int = 7,
) -> Model:
    """Fit on a bounded sample of the labelled rows: ``sample_rows`` of them are expected, chosen by a hash of the id.

    Only the sampled ids are broadcast, so texts aren't shuffled; what one task gets are the hashed n-grams of the
    sample, at most 2 * DIMENSIONS bytes a row. The driver receives the weights, whose number is fixed. Rows of
    ``labels`` with null ids or labels are left out; repeated ones count once, by the rounded mean of their labels.
    """
    spark = prepare(documents.sparkSession)
    known = (
        labels.select(F.col(doc_id).alias("id"), F.col(label).alias("label"))
        .dropna()
        .groupBy("id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    )
    total = known.count()
    share = min(1.0, sample_rows / max(total, 1))
    sample = known.filter(F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = documents.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("text")).join(
        F.broadcast(sample), "id"
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for start, stop, places in indicators(batch.column("text").to_pylist()):
                cuts = np.searchsorted(places, np.arange(1, stop - start) * DIMENSIONS)
                found += [(p % DIMENSIONS).astype("<u2").tobytes() for p in np.split(places, cuts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(found, pa.binary())], ["id", "label", "grams"]
            )

    schema = T.StructType([rows.schema["id"], T.StructField("label", T.IntegerType()), T.StructField("grams", T.BinaryType())])
    grams = rows.select("id", "label", "text").mapInArrow(extract, schema).groupBy("id", "label").agg(F.max("grams").alias("grams"))

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", kind="stable")
        model = fit_rows(
            [np.frombuffer(g, "<u2") for g in frame["grams"]], frame["label"].to_numpy(), smoothing, cost, epochs, seed
        )
        return pd.DataFrame(
            [[model.ratios.tobytes(), model.weights.tobytes(), model.bias, model.slope, model.offset]],
            columns=["ratios", "weights", "bias", "slope", "offset"],
        )

    found = (
        grams.groupBy(F.lit(0).alias("all"))
        .applyInPandas(solve, "ratios binary, weights binary, bias double, slope double, offset double")
        .first()
    )
    if found is None:
        return fit_rows([], np.zeros(0, int), smoothing, cost, epochs, seed)
    return Model(np.frombuffer(found.ratios), np.frombuffer(found.weights), found.bias, found.slope, found.offset)


def scores(texts: list[bytes | None], model: Model) -> np.ndarray:
    products, squares = model.weights * model.ratios, model.ratios**2
    out = np.zeros(len(texts))
    for start, stop, places in indicators(texts):
        row, bucket = places // DIMENSIONS, places % DIMENSIONS
        norm = np.sqrt(np.bincount(row, squares[bucket], stop - start))
        out[start:stop] = np.bincount(row, products[bucket], stop - start) / np.maximum(norm, 1e-6)
    return 1 / (1 + np.exp(-np.clip(model.slope * (out + model.bias) + model.offset, -700, 700)))


def score(
    df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",), name: str = "score"
) -> DataFrame:
    """The columns ``keep`` and ``name`` (0 to 1, higher: label 1 likelier) of every row, in one pass over the texts.

    A null text counts as empty: it has no n-gram, so its score is that of the bias alone. Repeated rows each return a
    row, with equal scores. An empty table gives an empty one. Where ``keep`` has a column named score, give another name.
    """
    prepare(df.sparkSession)
    chosen = df.select(F.col(text).cast("binary").alias("__text"), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scores(batch.column(0).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found)], [*batch.schema.names[1:], name])

    schema = T.StructType([*chosen.schema.fields[1:], T.StructField(name, T.DoubleType())])
    return chosen.mapInArrow(run, schema)
