"""Quality rules: counts of words, symbols and repeats, then a hashed n-gram log-likelihood ratio of trusted against raw text."""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.common import blocks, prepare, word_chunks

BITS = 13
BUCKETS = 1 << BITS
WINDOW = 5
_GRAM = 3
_SIZE = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
#: Odd multipliers, one for each word of a window.
_MULTIPLIERS = np.random.default_rng(5).integers(1, 1 << 63, WINDOW, dtype=np.uint64) | np.uint64(1)


class Stats(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int


def _repeated(words: np.ndarray) -> int:
    """Words that lie in a window of WINDOW words which occurs twice or more. Words come as 64-bit hashes."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    mixed = words * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    window = sum(mixed[k : k + n] * m for k, m in enumerate(_MULTIPLIERS))
    order = np.argsort(window, kind="stable")
    equal = window[order][1:] == window[order][:-1]
    if not equal.any():
        return 0
    # Equal sums are only candidates: the windows count where all five words agree.
    again = np.zeros(len(order), bool)
    again[1:] |= equal
    again[:-1] |= equal
    at = np.flatnonzero(again)
    rows = np.stack([words[order[at] + k] for k in range(WINDOW)])
    by = np.lexsort(rows)
    same = (rows[:, by][:, 1:] == rows[:, by][:, :-1]).all(0)
    twice = np.zeros(len(at), bool)
    twice[1:] |= same
    twice[:-1] |= same
    covered = np.zeros(len(words) + 1, np.int64)
    starts = order[at[by[twice]]]
    covered[starts] += 1
    np.add.at(covered, starts + WINDOW, -1)
    return int((covered.cumsum() > 0).sum())


def stats(text: bytes | None) -> Stats:
    """The base counts of one whole text; zeros for null. A long text is split in pieces, of which hashes are kept only."""
    if not text:
        return Stats(0, 0, 0, 0, 0)
    chars = symbols = 0
    hashes = []
    for piece in word_chunks(text):
        data = np.frombuffer(piece, np.uint8)
        chars += int(((data & 0xC0 != 0x80) & ~_SPACE[data]).sum())
        symbols += int(_SYMBOL[data].sum())
        words = piece.split()
        hashes.append(np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64))
    words = np.concatenate(hashes)
    lines = [line for line in text.split(b"\n") if line and not line.isspace()] if b"\n" in text else []
    return Stats(len(words), chars, symbols, len(lines) - len(set(lines)), _repeated(words))


def base_failed(s: Stats) -> bool:
    return s.n_words < 10 or 100 * s.n_repeat_words > 20 * s.n_words


def _grams(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row, bucket)`` of the byte n-grams of whole texts, in pieces of bounded size, rows ascending. Texts are kept apart."""
    for start, stop in blocks(texts, 1 << 16, _SIZE):
        if stop - start > 1 or len(texts[start] or b"") <= _SIZE:
            group = [t or b"" for t in texts[start:stop]]
            lengths = np.array([len(t) for t in group])
            data = np.frombuffer(b"".join(group), np.uint8)
            row = np.repeat(np.arange(start, stop), lengths)
            if len(data) >= _GRAM:
                inside = row[: 1 - _GRAM] == row[_GRAM - 1 :]
                yield row[: 1 - _GRAM][inside], _hashed(data)[inside]
        else:
            whole = texts[start]
            for at in range(0, len(whole), _SIZE - _GRAM + 1):
                data = np.frombuffer(whole[at : at + _SIZE], np.uint8)
                if len(data) >= _GRAM:
                    bucket = _hashed(data)
                    yield np.full(len(bucket), start), bucket


def _hashed(data: np.ndarray) -> np.ndarray:
    code = data[: 1 - _GRAM].astype(np.uint32)
    for k in range(1, _GRAM):
        code |= data[k : len(data) - _GRAM + 1 + k].astype(np.uint32) << np.uint32(8 * k)
    return (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def fit(df: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text", prior: float = 2.0) -> np.ndarray:
    """log p(bucket | trusted) - log p(bucket | raw), over all n-grams of all rows.

    Raw is every row of ``df``, trusted those whose id is in ``trusted``. Each task folds its rows to two counts per bucket, so
    what is summed and what the driver gets has a fixed size. The trusted counts are smoothed by ``prior`` * BUCKETS n-grams
    distributed as in raw text, so an n-gram that little trusted text happens to lack says little. Without trusted n-grams
    the ratio is 0 everywhere.

    ``trusted`` has no size bound, so it is never broadcast: the texts are shuffled by id once, at every size.
    """
    prepare(df.sparkSession)
    rows = df.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("text")).filter("text is not null")
    marks = trusted.select(F.col(doc_id).alias("id"), F.lit(True).alias("trusted")).dropna().distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, raw = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            mark = np.array(batch.column(1).is_valid())
            for row, bucket in _grams(batch.column(0).to_pylist()):
                raw += np.bincount(bucket, minlength=BUCKETS)
                target += np.bincount(bucket[mark[row]], minlength=BUCKETS)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(target[at]), pa.array(raw[at])], ["bucket", "target", "raw"]
        )

    counted = (
        rows.join(marks.hint("merge"), "id", "left")
        .select("text", "trusted")
        .mapInArrow(count, "bucket int, target bigint, raw bigint")
        .groupBy("bucket")
        .agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))
    )
    target, raw = np.zeros(BUCKETS), np.zeros(BUCKETS)
    found = counted.toPandas()
    target[found["bucket"]] += found["target"]
    raw[found["bucket"]] += found["raw"]
    return weigh(target, raw, prior)


def weigh(target: np.ndarray, raw: np.ndarray, prior: float = 2.0) -> np.ndarray:
    """The log ratio of two multinomials given by counts."""
    if not target.sum():
        return np.zeros(BUCKETS)
    share = (raw + 1) / (raw + 1).sum()
    smoothed = target + prior * BUCKETS * share
    return np.log(smoothed / smoothed.sum()) - np.log(share)


def ratios(texts: list[bytes | None], weights: np.ndarray) -> np.ndarray:
    """Mean log-likelihood ratio of each text's n-grams; 0 for texts without one."""
    total, count = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    for row, bucket in _grams(texts):
        total += np.bincount(row, weights[bucket], len(texts))
        count += np.bincount(row, minlength=len(texts))
    return total / np.maximum(count, 1)


def judge(
    df: DataFrame, weights: np.ndarray, threshold: float = -0.25, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns ``keep``, the base counts, ``base_failed``, ``ratio`` and ``kept`` of every row, in one pass.

    A row is kept if it passes the base rules and its mean ratio reaches the threshold, the same for every document. Null
    texts have no words, so they fail the base rules. Repeated rows each return a row. Columns of ``keep`` with our names
    would clash: rename them first.
    """
    prepare(df.sparkSession)
    chosen = df.select(F.col(text).cast("binary").alias("__text"), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            found = [stats(t) for t in texts]
            failed = [base_failed(s) for s in found]
            ratio = ratios(texts, weights)
            columns = [pa.array([getattr(s, name) for s in found], pa.int64()) for name in Stats._fields]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[1:],
                    *columns,
                    pa.array(failed, pa.bool_()),
                    pa.array(ratio),
                    pa.array(~np.array(failed, bool) & (ratio >= threshold)),
                ],
                [*batch.schema.names[1:], *Stats._fields, "base_failed", "ratio", "kept"],
            )

    fields = [T.StructField(name, T.LongType()) for name in Stats._fields]
    fields += [T.StructField("base_failed", T.BooleanType()), T.StructField("ratio", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    return chosen.mapInArrow(run, T.StructType([*chosen.schema.fields[1:], *fields]))
