"""Near duplicates by SimHash, with pigeonring filtering of the candidates."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.common import prepare, stored, word_chunks
from logloom.llm.components import connected

BITS = 64
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: bytes | None, shingle: int = 4, seed: int = 42) -> int:
    """SimHash of one text, as an unsigned number; 0 when it has no word."""
    ones, total, tail = np.zeros(BITS, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for chunk in word_chunks((text or b"").translate(_LOWER)):
        words = tail + chunk.split()
        tail = words[1 - shingle :] if shingle > 1 else []
        if len(words) < shingle:
            tail = words
            continue
        joined = b" ".join(words)
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        starts = [0, *(gaps[: len(words) - shingle] + 1).tolist()]
        ends = [*gaps[shingle - 1 :].tolist(), len(joined)]
        hashes = np.array([digest(joined[s:e], seed) for s, e in zip(starts, ends)], "<u8")
        total += len(hashes)
        ones += _ones(hashes)
    if not total and tail:
        hashes = np.array([digest(b" ".join(tail), seed)], "<u8")
        total, ones = 1, _ones(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0]) if total else 0


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How often each bit is set. Rows are added in eights of a byte's range first, which stays vectorised."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    whole = len(bits) // 255 * 255
    ones = bits[whole:].sum(0, dtype=np.uint8).astype(np.int64)
    if whole:
        ones += bits[:whole].reshape(-1, 255, BITS).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
    return ones


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """``(id, fingerprint)`` per row, the fingerprint as a signed long of the same 64 bits. Null texts have none: 0."""
    prepare(df.sparkSession)
    chosen = df.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fingerprint"])

    schema = T.StructType([chosen.schema["id"], T.StructField("fingerprint", T.LongType())])
    return chosen.mapInArrow(run, schema)


def _ring(distance: int) -> list[tuple[int, int]]:
    """(offset, width) of distance + 1 consecutive segments, so that one segment of a link never differs."""
    n = distance + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _segment(x: Column, ring: list[tuple[int, int]], i: int) -> Column:
    offset, width = ring[i % len(ring)]
    return F.shiftrightunsigned(x, offset).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _chain_key(x: Column, ring: list[tuple[int, int]], i: int) -> Column:
    """Start of the chain, its first and its second segment in one number."""
    return F.lit(i << 48).cast("long").bitwiseOR(F.shiftleft(_segment(x, ring, i), 24)).bitwiseOR(_segment(x, ring, i + 1))


def _first_chain(x: Column, ring: list[tuple[int, int]], distance: int) -> Column:
    """The first start from which every chain of l segments has at most floor(l * distance / segments) differences.

    By the pigeonring principle there is one whenever x, the exclusive or of two fingerprints, has ``distance`` bits or fewer.
    """
    n = len(ring)
    bits = [F.bit_count(_segment(x, ring, i)) for i in range(n)]
    first = F.lit(None).cast("int")
    for start in reversed(range(n)):
        viable, total = F.lit(True), F.lit(0)
        for length in range(1, n):
            total = total + bits[(start + length - 1) % n]
            viable = viable & (total <= length * distance // n)
        first = F.when(viable, F.lit(start)).otherwise(first)
    return first


def links(distinct: DataFrame, distance: int = 4) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of distinct fingerprints that differ in at most ``distance`` (2 to 8) bits; each pair once.

    Chains of two segments make the join: the first must be equal and the second may differ in the bits that its budget
    leaves (one of them: floor(2 * distance / segments)), so one side carries every such neighbour of its chain and the other its own. What meets
    is pruned by the budgets of the longer chains before the full Hamming check; a pair that meets at several starts
    counts at the first viable one only, so no later step has to drop repeats.
    """
    if not 2 <= distance <= 8:
        raise ValueError("distance must be 2 to 8")
    ring = _ring(distance)
    x = F.col("fingerprint")
    own, near = [], []
    for i in range(len(ring)):
        key = _chain_key(x, ring, i)
        own.append(key)
        near += [key, *(key.bitwiseXOR(F.lit(1 << bit).cast("long")) for bit in range(ring[(i + 1) % len(ring)][1]))]
    probe = distinct.select(x.alias("a"), F.explode(F.array(*near)).alias("key"))
    index = distinct.select(x.alias("b"), F.explode(F.array(*own)).alias("key"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    start = F.shiftrightunsigned(probe["key"], 48).cast("int")
    meets = (
        (probe["key"] == index["key"])
        & (F.col("a") < F.col("b"))
        & (F.bit_count(differ) <= distance)
        & (_first_chain(differ, ring, distance) == start)
    )
    return probe.join(index, meets).select("a", "b")


def groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = 4, shingle: int = 4) -> DataFrame:
    """``(id, fingerprint, component_id)`` for every row: linked fingerprints and their classes.

    Equal fingerprints are folded first, so copies never meet as pairs. component_id is the smallest id reachable (null
    only where no row of the group has an id). Null and empty texts have fingerprint 0 and are linked like any other.
    Rows with the same id each return a row. An empty table gives an empty result. Other columns are not read.
    """
    every = stored(fingerprints(df, doc_id, text, shingle), "fingerprints")
    distinct = stored(every.groupBy("fingerprint").agg(F.min("id").alias("least")), "distinct-fingerprints")
    found = connected(links(distinct, distance)).withColumnRenamed("node", "fingerprint")
    linked = found.join(distinct, "fingerprint")
    classes = linked.groupBy("root").agg(F.min("least").alias("reached"))
    moved = linked.join(classes, "root").select("fingerprint", "reached")
    # A written table: both sides of the last join are then exchanges, of which a hot one can be split.
    reached = stored(
        distinct.join(moved, "fingerprint", "left").select("fingerprint", F.coalesce("reached", "least").alias("component_id")),
        "fingerprint-classes",
    )
    return every.join(reached, "fingerprint").select("id", "fingerprint", "component_id")


def hexadecimal(fingerprint: Column) -> Column:
    """16 lowercase digits of the unsigned number."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
