"""Language ID as multilingual mixture inference: expectation-maximisation of each document's language proportions."""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.common import blocks, prepare

BUCKETS = 1 << 14
_ROWS, _SIZE = 64, 1 << 20
_MOST_CELLS = 1 << 25

#: Bytes as the n-grams see them: A-Z lower-cased, every other ASCII character but letters a space, the rest as it is.
_PLAIN = np.full(256, 32, np.uint8)
_PLAIN[128:] = np.arange(128, 256)
_PLAIN[97:123] = np.arange(97, 123)
_PLAIN[65:91] = np.arange(97, 123)


class Model(NamedTuple):
    languages: list[str]
    #: log p(bucket | language), languages in columns.
    logs: np.ndarray


def _trigrams(texts: list[bytes | None], rows: int) -> np.ndarray:
    """How often each hashed trigram occurs in each text: rows * BUCKETS counts. A text begins and ends with a space."""
    lengths = np.array([len(t or b"") for t in texts])
    data = _PLAIN[np.frombuffer(b" ".join([b"", *(t or b"" for t in texts), b""]), np.uint8)]
    # The spaces between texts belong to none; a trigram belongs to the text of its middle byte.
    row = np.full(len(data), rows, np.int32)
    first = np.cumsum(lengths + 1) - lengths
    inside = np.ones(len(data), bool)
    inside[np.append(first - 1, len(data) - 1)] = False
    row[inside] = np.repeat(np.arange(rows, dtype=np.int32), lengths)
    # Of a run of spaces the first stays, or those between texts.
    space, between = data == 32, row == rows
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    run = np.cumsum(begins)
    holds = np.zeros(run[-1] + 1, bool)
    holds[run[between]] = True
    keep = ~space | between | (begins & ~holds[run])
    data, row = data[keep].astype(np.uint32), row[keep]
    counts = np.bincount(row[1:-1] * BUCKETS + _buckets(data), minlength=(rows + 1) * BUCKETS)
    return counts[: rows * BUCKETS]


def _buckets(data: np.ndarray) -> np.ndarray:
    """The hashed trigrams of a sequence of bytes, in order."""
    code = data[:-2] | data[1:-1] << np.uint32(8) | data[2:] << np.uint32(16)
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - 14)).astype(np.int32)


def _long_trigrams(text: bytes) -> np.ndarray:
    """The same counts for one text, piece by piece; the last two bytes that count go on into the next piece."""
    counts = np.zeros(BUCKETS, np.int64)
    last = np.array([32], np.uint8)
    for at in range(0, len(text) + 1, _SIZE):
        piece = _PLAIN[np.frombuffer(text[at : at + _SIZE], np.uint8)]
        ends = at + _SIZE > len(text)
        data = np.concatenate([last, piece, np.full(int(ends), 32, np.uint8)])
        space = data == 32
        keep = ~space
        keep[0] = True
        keep[1:] |= ~space[:-1]
        data = data[keep]
        if len(data) > 2:
            counts += np.bincount(_buckets(data.astype(np.uint32)), minlength=BUCKETS)
        last = data[-2:]
    return counts


def profiles(texts: list[bytes | None]) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(first row, last row + 1, counts)`` by blocks.

    A text longer than a block is counted in pieces, with the counts that it would have in one.
    """
    for start, stop in blocks(texts, _ROWS, _SIZE):
        rows = stop - start
        if rows > 1:
            yield start, stop, _trigrams(texts[start:stop], rows)
        else:
            yield start, stop, _long_trigrams(texts[start] or b"")


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    if text.isascii():
        return not text.isdigit() and any(65 <= b <= 90 or 97 <= b <= 122 for b in text)
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def fit(df: DataFrame, language: str = "lang", text: str = "text", smoothing: float = 0.5) -> Model:
    """Trigram multinomials of every language of the rows given, over all of them.

    Each task folds its texts to at most languages * BUCKETS counts, which are summed by a shuffle; the driver gets as many
    numbers, and raises an error where the languages are so many that this would be more than 2^25. Rows without a
    language or a text are left out.
    """
    prepare(df.sparkSession)
    rows = df.select(F.col(language).cast("string").alias("lang"), F.col(text).cast("binary").alias("text")).dropna()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, stop, counts in profiles(texts):
                for i, profile in enumerate(counts.reshape(stop - start, BUCKETS)):
                    if names[start + i] not in sums:
                        sums[names[start + i]] = np.zeros(BUCKETS, np.int64)
                    sums[names[start + i]] += profile
        for name, profile in sums.items():
            at = np.flatnonzero(profile)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(profile[at])], ["lang", "bucket", "n"]
            )

    total = rows.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # One row per language; sorted inside, so that the same counts give the same model.
    found = total.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))
    languages, columns = [], []
    for row in found.orderBy("lang").toLocalIterator():
        if (len(languages) + 1) * BUCKETS > _MOST_CELLS:
            raise ValueError(f"more than {_MOST_CELLS // BUCKETS} languages")
        counts = np.full(BUCKETS, smoothing)
        for bucket, n in row.counts:
            counts[bucket] += n
        languages.append(row.lang)
        columns.append(np.log(counts / counts.sum()))
    return Model(languages, np.array(columns).T.reshape(BUCKETS, len(languages)))


def mixtures(counts: np.ndarray, rows: int, logs: np.ndarray, penalty: float = 4.0, steps: int = 12) -> np.ndarray:
    """Proportions of the languages in each of ``rows`` texts, 0 for those outside a text's language set.

    A set grows from the likeliest single language. The next to try is the one with the steepest gain in likelihood; as
    the likelihood is concave in the proportions, the gain is at most n * (slope - 1), so texts for which that bound
    stays below the penalty, ``penalty`` * ln(n), are done without a fit. For the others expectation-maximisation fits the proportions,
    and the language stays if the likelihood grows by more than the penalty.
    """
    cells = np.flatnonzero(counts)
    row, bucket, n = cells // BUCKETS, cells % BUCKETS, counts[cells].astype(np.float64)
    languages = logs.shape[1]
    sums = np.bincount(row, n, rows)
    cuts = np.searchsorted(row, np.arange(rows))
    filled = np.flatnonzero(np.bincount(row, minlength=rows))

    def by_row(values: np.ndarray, of: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
        out = np.zeros((count, *values.shape[1:]))
        if len(values):
            out[of] = np.add.reduceat(values, starts[of], axis=0)
        return out

    single = by_row(n[:, None] * logs[bucket], filled, cuts, rows)
    theta = np.zeros((rows, languages))
    best = single.argmax(1)
    theta[filled, best[filled]] = 1.0
    likelihood = single.max(1)
    open_rows = filled
    odds = np.exp(logs)
    while len(open_rows):
        inside = np.zeros(rows, bool)
        inside[open_rows] = True
        chosen = inside[row]
        place = np.full(rows, -1)
        place[open_rows] = np.arange(len(open_rows))
        r, p, m = place[row[chosen]], odds[bucket[chosen]], n[chosen]
        starts = np.searchsorted(r, np.arange(len(open_rows)))
        every = np.arange(len(open_rows))
        current = theta[open_rows]
        total = sums[open_rows]
        mixed = (p * current[r]).sum(1)
        slope = by_row((m / mixed)[:, None] * p, every, starts, len(open_rows)) / total[:, None]
        slope[current > 0] = 0
        added = slope.argmax(1)
        cost = penalty * np.log(np.maximum(total, 2.0))
        going = (slope.max(1) - 1) * total > cost
        if not going.any():
            break
        at = np.flatnonzero(going)
        part = going[r]
        lookup = np.full(len(open_rows), -1)
        lookup[at] = np.arange(len(at))
        r, p, m = lookup[r[part]], p[part], m[part]
        starts, every = np.searchsorted(r, np.arange(len(at))), np.arange(len(at))
        share = current[at] * 0.8
        share[every, added[at]] = 0.2
        for _ in range(steps):
            weighted = p * share[r]
            weighted *= (m / weighted.sum(1))[:, None]
            share = by_row(weighted, every, starts, len(at)) / total[at][:, None]
        reached = by_row(m * np.log((p * share[r]).sum(1)), every, starts, len(at))
        rows_at = open_rows[at]
        better = reached - likelihood[rows_at] > cost[at]
        theta[rows_at[better]] = share[better]
        likelihood[rows_at[better]] = reached[better]
        open_rows = rows_at[better]
        open_rows = open_rows[(theta[open_rows] > 0).sum(1) < languages]
    return theta


def predict(
    df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",), unknown: str = "und", penalty: float = 4.0
) -> DataFrame:
    """The columns ``keep``, ``lang_pred``, its ``score`` (the language's share of the text) and ``mixture`` (language to share).

    ``unknown`` with score 0 and no mixture where the text is null or has no letter, or no language was learned. Equal
    shares: the first language by code point.
    Repeated rows each return a row. Columns of ``keep`` with our names would clash: rename them first.
    """
    prepare(df.sparkSession)
    chosen = df.select(F.col(text).cast("binary").alias("__text"), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            names, scores, mixed = [unknown] * len(texts), np.zeros(len(texts)), [[]] * len(texts)
            for start, stop, counts in profiles(texts) if model.languages else ():
                theta = mixtures(counts, stop - start, model.logs, penalty)
                for i, share in enumerate(theta):
                    if has_letter(texts[start + i]):
                        top = int(share.argmax())
                        names[start + i], scores[start + i] = model.languages[top], share[top]
                        mixed[start + i] = [(model.languages[j], float(share[j])) for j in np.flatnonzero(share)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[1:],
                    pa.array(names, pa.string()),
                    pa.array(np.clip(scores, 0.0, 1.0)),
                    pa.array(mixed, pa.map_(pa.string(), pa.float64())),
                ],
                [*batch.schema.names[1:], "lang_pred", "score", "mixture"],
            )

    fields = [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("mixture", T.MapType(T.StringType(), T.DoubleType())),
    ]
    return chosen.mapInArrow(run, T.StructType([*chosen.schema.fields[1:], *fields]))
