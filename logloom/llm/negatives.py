"""Hard negatives by inner product, with length buckets and coordinate pruning of what has to be verified."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import prepare, stored

#: Rows and anchors of a block, rows of a length bucket in it, anchors whose scores are held at once, coordinates tried per anchor.
ROWS, ANCHORS, BUCKET, HELD, FOCUS = 8192, 4096, 1024, 256, 4
#: Above this share of a bucket the candidates are no fewer than all: the anchor joins those that multiply the whole bucket.
_DENSE = 0.25
_EXACT = float(1 << 53)
_SLACK = 1e-9


@dataclass
class Bucket:
    """Vectors of similar length: whole numbers, lengths, and every coordinate of the unit vectors as a sorted list."""

    x: np.ndarray
    lengths: np.ndarray

    def __post_init__(self):
        self.most = float(self.lengths.max())
        self.unit = self.x / np.where(self.lengths > 0, self.lengths, 1)[:, None]
        self.order = np.argsort(self.unit, 0, kind="stable")
        self.sorted = np.take_along_axis(self.unit, self.order, 0)

    def candidates(self, unit: np.ndarray, local: np.ndarray) -> Iterator[tuple[int, np.ndarray | None]]:
        """(anchor, its candidate rows, or None for all) for unit anchors and the cosines, above 0, that rows have to reach.

        With cosine t or more to the anchor, coordinate f of a row lies within t q ± sqrt((1 - t²)(1 - q²)) (the
        upper end is 1 where q itself is above t). The anchor's largest coordinates are its focus; the shortest range is
        read off its sorted list, and the others' ranges are intersected with it.
        """
        focus = np.argsort(-np.abs(unit), 1, kind="stable")[:, :FOCUS]
        q = np.take_along_axis(unit, focus, 1)
        t = np.minimum(local, 1)[:, None]
        spread = np.sqrt(np.maximum((1 - t * t) * (1 - q * q), 0))
        low = np.where(q < -t, -1.0, t * q - spread) - _SLACK
        high = np.where(q > t, 1.0, t * q + spread) + _SLACK
        first, last = np.zeros(q.shape, np.int64), np.zeros(q.shape, np.int64)
        for f in np.unique(focus):
            at = focus == f
            first[at] = np.searchsorted(self.sorted[:, f], low[at], "left")
            last[at] = np.searchsorted(self.sorted[:, f], high[at], "right")
        best = np.argmin(last - first, 1)
        for i in range(len(unit)):
            j = best[i]
            begin, end = first[i, j], last[i, j]
            if end - begin > _DENSE * len(self.x):
                yield i, None
                continue
            rows = self.order[begin:end, focus[i, j]]
            for k in range(focus.shape[1]):
                if k != j:
                    c = self.unit[rows, focus[i, k]]
                    rows = rows[(c >= low[i, k]) & (c <= high[i, k])]
            yield i, rows


class Best:
    """The first ``k`` rows by score (then id) within each of an anchor's windows of scores, as buckets come in."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        self.need = low.copy()  # of each window, what a row has to reach to change it
        empty = np.zeros(0, np.int64)
        self.found = (empty, empty, np.zeros(0, low.dtype), empty, empty.astype(bool))  # slot, row, score, id, no id

    def add(self, anchors: np.ndarray, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        """Take in pairs; those outside a window leave it as it is."""
        windows, parts = self.low.shape[1], [self.found]
        for w in range(windows):
            fits = (scores >= self.need[anchors, w]) & (scores <= self.high[anchors, w])
            parts.append((anchors[fits] * windows + w, rows[fits], scores[fits], ids[rows[fits]], no_id[rows[fits]]))
        slot, row, score, key, none = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((key, none, -score, slot))
        slot = slot[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot, "left")
        kept = rank < self.k
        self.found = (slot[kept], *(c[order[kept]] for c in (row, score, key, none)))
        full = rank == self.k - 1
        self.need.reshape(-1)[slot[full]] = score[order[full]]


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: in double precision where no sum can pass 2^53, else as Python integers."""
    a, b = q.astype(np.float64), x.astype(np.float64)
    if not len(a) or not len(b) or np.sqrt((a * a).sum(1).max() * (b * b).sum(1).max()) < _EXACT:
        return a @ b.T
    return q.astype(object) @ x.astype(object).T


def search(
    q: np.ndarray, x: np.ndarray, ids: np.ndarray, no_id: np.ndarray, barred, low: np.ndarray, high: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """(anchor, window, row, score) of the first ``k`` rows in each window, and how many pairs were verified.

    ``low`` and ``high`` bound each anchor's windows, a window with low > high is empty. ``barred(anchors, rows)`` says which pairs don't count
    (it broadcasts like its arguments). Buckets are taken by falling length.
    """
    lengths, sizes = np.sqrt((q.astype(np.float64) ** 2).sum(1)), np.sqrt((x.astype(np.float64) ** 2).sum(1))
    unit = q / np.where(lengths > 0, lengths, 1)[:, None]
    by_length = np.argsort(-sizes, kind="stable")
    kind = np.float64 if lengths.max(initial=0) * sizes.max(initial=0) < _EXACT else object
    best, verified = Best(low.astype(kind), high.astype(kind), k), 0
    least = kind(-np.inf) if kind is np.float64 else -(1 << 200)
    for at in range(0, len(x), BUCKET):
        rows = by_length[at : at + BUCKET]
        bucket = Bucket(x[rows], sizes[rows])
        # What a row has to reach in the least demanding open window, and the cosine that this asks of the longest row.
        open_ = np.where(best.low <= best.high, best.need, np.inf)
        need = open_.min(1).astype(np.float64) if open_.shape[1] else np.full(len(q), np.inf)
        # A null vector's products are all 0, so it asks for everything or nothing.
        local = np.where(np.isinf(need), need, need / np.where(lengths > 0, lengths * max(bucket.most, 1e-300), 1))
        local = np.where(lengths > 0, local, np.where(need > 0, np.inf, -1))
        alive = local <= 1 + _SLACK
        dense = list(np.flatnonzero(alive & (local <= 0)))
        some = np.flatnonzero(alive & (local > 0))
        for i, chosen in bucket.candidates(unit[some], local[some]):
            a = some[i]
            if chosen is None:
                dense.append(a)
            elif len(chosen):
                chosen = chosen[~barred(np.full(len(chosen), a), rows[chosen])]
                verified += len(chosen)
                found = _scores(q[a : a + 1], bucket.x[chosen])[0].astype(kind)
                best.add(np.full(len(chosen), a), rows[chosen], found, ids, no_id)
        dense = np.sort(np.array(dense, np.int64))
        for start in range(0, len(dense), HELD):
            a = dense[start : start + HELD]
            products = _scores(q[a], bucket.x).astype(kind)
            out = barred(a[:, None], rows[None, :])
            verified += int(out.size - out.sum())
            products[out] = least
            taken = np.zeros(products.shape, bool)
            for w in range(low.shape[1]):
                inside = np.where((products >= best.need[a, w, None]) & (products <= best.high[a, w, None]), products, least)
                # All that tie with the k-th stay, so that ids can decide.
                kth = np.partition(inside, -k, 1)[:, -k, None] if inside.shape[1] > k else least
                taken |= (inside >= kth) & (inside > least)
            i, j = np.nonzero(taken)
            best.add(a[i], rows[j], products[i, j], ids, no_id)
    slot, row, score, _, _ = best.found
    windows = max(low.shape[1], 1)
    return slot // windows, slot % windows, row, np.array([int(s) for s in score], np.int64), verified


def _share(score: Column, percent: int, up: bool) -> Column:
    """percent * score / 100 in whole numbers, rounded up or down."""
    product = (score * percent).cast("long")
    rest = F.pmod(product, F.lit(100))
    down = F.call_function("div", product - rest, F.lit(100))
    return F.when(rest > 0, down + (1 if up else 0)).otherwise(down).cast("long")


def _codes(left: pa.ChunkedArray, right: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Labels of any type as numbers that are equal where the labels are."""
    both = pa.chunked_array([*left.chunks, *right.chunks]).combine_chunks().dictionary_encode().indices.to_numpy()
    return both[: len(left)], both[len(left) :]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.stack([np.zeros(0, np.int64), *column.to_numpy(zero_copy_only=False)][1:]) if len(column) else np.zeros((0, 0), np.int64)


def _ids(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    return table[name].fill_null(0).to_numpy(), table[name].is_null().to_numpy()


def _meet(anchors: DataFrame, rows: DataFrame, keys: list[str]):
    """Both sides dealt into groups of bounded size in which every anchor meets every row of equal ``keys``, once.

    A third of all rows under one key is so many more groups. Rows of a block are of similar length, and an
    anchor (with ``reach``, the least length that a row needs, where it has one) isn't sent to blocks of shorter rows.
    """
    bands = rows.groupBy(*keys, "band").agg(F.ceil(F.count("*") / ROWS).cast("int").alias("n_blocks"))
    sets = anchors.groupBy(*keys).agg(F.ceil(F.count("*") / ANCHORS).cast("int").alias("n_sets"))
    bands, sets = stored(bands, "row-bands"), stored(sets, "anchor-sets")
    where = rows.join(bands, [*keys, "band"]).join(sets, keys)
    own = F.pmod(F.xxhash64("row"), F.col("n_blocks")).cast("int")
    left = where.withColumn("block", own).withColumn("set", F.explode(F.sequence(F.lit(0), F.col("n_sets") - 1))).drop("n_blocks", "n_sets")
    listed = bands.groupBy(*keys).agg(F.collect_list(F.struct("band", "n_blocks")).alias("bands"))
    mine = anchors.join(sets, keys).join(listed, keys)
    mine = mine.withColumn("set", F.pmod(F.xxhash64("anchor"), F.col("n_sets")).cast("int"))
    if "reach" in anchors.columns:
        mine = mine.withColumn("bands", F.filter("bands", lambda b: F.pow(F.lit(2.0), (b["band"] + 1) / 4) * (1 + _SLACK) >= F.col("reach")))
    mine = mine.select("*", F.inline("bands")).drop("bands", "n_sets")
    mine = mine.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).drop("n_blocks")
    place = [*keys, "set", "band", "block"]
    # Both sides come from one table: an alias gives one side columns of its own.
    mine = mine.select(*[F.col(c).alias(c) for c in mine.columns])
    return mine.groupBy(*place).cogroup(left.groupBy(*place))


def vectors(df: DataFrame, anchors: Column, vec_id: str, vector: str, label: str, scale: int) -> DataFrame:
    """``(row, id, label, x, dim, band, anchor)`` of the rows that take part, written; ``row`` tells apart rows that repeat an id."""
    v, limit = F.col(vector), float(1 << 61)

    def fine(c: Column) -> Column:
        c = c.cast("double") * scale
        return F.coalesce((c > -limit) & (c < limit), F.lit(False))

    chosen = df.filter(F.col(label).isNotNull() & F.coalesce(F.forall(v, fine), F.lit(False)))
    x = F.transform(v, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    known = chosen.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(vec_id).cast("long").alias("id"),
        F.col(label).alias("label"),
        x.alias("x"),
        F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
    )
    square = F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    return stored(
        known.select(
            "*",
            F.size("x").alias("dim"),
            F.sqrt(square).alias("length"),
            F.when(square > 0, F.floor(F.log2(F.sqrt(square)) * 4)).otherwise(-10_000).cast("int").alias("band"),
        ),
        "mined-vectors",
    )


def positives(known: DataFrame, k: int) -> DataFrame:
    """``(anchor, positive_id, positive_score)``: each anchor's first ``k`` other rows of its label."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        anchor, row = left["anchor"].to_numpy(), right["row"].to_numpy()
        ids, no_id = _ids(right, "id")
        bounds = np.full((len(anchor), 1), np.inf)
        x = _matrix(right["x"]) if len(anchor) and len(row) else None
        if x is None:
            return pa.table({"anchor": anchor[:0], "id": right["id"].slice(0, 0), "score": anchor[:0]})
        a, _, r, score, _ = search(_matrix(left["q"]), x, ids, no_id, lambda i, j: anchor[i] == row[j], -bounds, bounds, k)
        return pa.table({"anchor": anchor[a], "id": right["id"].combine_chunks().take(pa.array(r)), "score": score})

    anchors = known.filter("is_anchor").select(F.col("row").alias("anchor"), "label", "dim", F.col("x").alias("q"))
    rows = known.select("row", "id", "label", "dim", "band", "x")
    found = _meet(anchors, rows, ["label", "dim"]).applyInArrow(run, "anchor long, id long, score long")
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k)


def mine(
    df: DataFrame,
    anchors: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    n_positives: int = 5,
    n_negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Components become floor(scale * x); a score is the integer inner product with the anchor, higher scores come first, ties by smaller id.
    ``anchors`` says which rows ask. An anchor's positives are its first ``n_positives`` other rows of the same label; the negatives of
    each are the first ``n_negatives`` rows of other labels with low * p <= 100 * s <= high * p, p the positive's score.

    The anchors are a stated query set that meets all rows, in blocks of bounded size; nothing but the first of each
    block is written out. In a block, buckets of falling length are searched with the score that the least demanding window still
    asks for, which bounds the cosine and by it the coordinates (``Bucket.candidates``); candidates are verified exactly.

    Rows with a null label or vector, or with a null or non-finite component (or one too large for a long), take no part. Rows that repeat an
    id are rows of their own and may be each other's positives; a null id comes last among ties. Vectors of another length have no
    product with an anchor. Scores of 2^53 and more are exact, one beyond a long is an error. An empty table, or
    no anchor, gives an empty result.
    """
    prepare(df.sparkSession)
    known = vectors(df, anchors, vec_id, vector, label, scale)
    pairs = stored(positives(known, n_positives), "positives")
    of = pairs.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("positives"))
    asked = (
        known.filter("is_anchor")
        .select(F.col("row").alias("anchor"), F.col("label").alias("own"), "dim", F.col("x").alias("q"), F.col("id").alias("anchor_id"), "length")
        .join(of, "anchor")
    )
    asked = asked.withColumn("low", F.transform("positives", lambda p: _share(p["score"], low, up=True)))
    asked = asked.withColumn("high", F.transform("positives", lambda p: _share(p["score"], high, up=False)))
    asked = stored(asked.withColumn("reach", F.when(F.col("length") > 0, F.array_min("low") / F.col("length")).otherwise(0.0)), "anchors-asking")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            none = np.zeros(0, np.int64)
            return pa.table({"anchor": none, "place": none.astype(np.int32), "id": right["id"].slice(0, 0), "score": none})
        anchor, ranks = left["anchor"].to_numpy(), left["low"].to_pylist()
        wide = max(map(len, ranks))
        bounds = np.array([[*r, *[1] * (wide - len(r))] for r in ranks]), np.array([[*r, *[0] * (wide - len(r))] for r in left["high"].to_pylist()])
        own, labels = _codes(left["own"], right["label"])
        ids, no_id = _ids(right, "id")
        a, w, r, score, _ = search(
            _matrix(left["q"]), _matrix(right["x"]), ids, no_id, lambda i, j: own[i] == labels[j], *bounds, n_negatives
        )
        found = right["id"].combine_chunks().take(pa.array(r))
        return pa.table({"anchor": anchor[a], "place": (w + 1).astype(np.int32), "id": found, "score": score})

    rows = known.select("row", "id", "label", "dim", "band", "x")
    sent = asked.select("anchor", "own", "dim", "q", "low", "high", "reach")
    found = _meet(sent, rows, ["dim"]).applyInArrow(run, "anchor long, place int, id long, score long")
    first = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= n_negatives)
    named = asked.select("anchor", "anchor_id", F.inline("positives")).select(
        "anchor", "place", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return ranked.join(named, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
