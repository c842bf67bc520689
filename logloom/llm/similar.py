"""Pairs of texts that share most of their word shingles: candidates by SimHash and by min-hash bands, each pair checked exactly."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm import simhash
from logloom.llm.common import prepare, stored, word_chunks
from logloom.llm.components import connected

#: Bands and minima in each. A pair of similarity s shares a band with a chance of 1 - (1 - s^8)^40: at 0.8 one of 1,500 is missed,
#: at 0.85 one of 300,000; at 0.5 one of seven shares one, so that a common passage alone gathers few texts.
BANDS, ROWS = 40, 8
#: A band of up to so many texts is compared across its classes; the texts of wider ones are joined by the rarest of their shingles.
WIDE = 32
#: Shingles are ordered by how often texts have one of their bucket: so many buckets, as a power of two.
_BUCKETS = 18
#: Texts of one shingle that a task compares with as many others.
_CHUNK = 256
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_FACTORS = np.random.default_rng(17).integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def described(text: bytes | None, shingle: int = 5) -> tuple[np.ndarray, int]:
    """Distinct XXH64 values of a text's word shingles, sorted, and its SimHash; fewer words are one shingle, no word is none."""
    found, tail, total, ones = [], [], 0, np.zeros(simhash.BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for chunk in word_chunks((text or b"").translate(_LOWER)):
        words = tail + chunk.split()
        hashes = np.array([digest(b" ".join(words[i : i + shingle]), 42) for i in range(len(words) - shingle + 1)], "<u8")
        tail = words[max(0, len(words) - shingle + 1) :]
        if len(hashes):
            total += len(hashes)
            ones += simhash._ones(hashes)
            found.append(np.unique(hashes))
    if not total and tail:
        found, total = [np.array([digest(b" ".join(tail), 42)], "<u8")], 1
        ones = simhash._ones(found[0])
    if not total:
        return np.zeros(0, np.uint64), 0
    return np.unique(np.concatenate(found)), int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def shingles(text: bytes | None, shingle: int = 5) -> np.ndarray:
    return described(text, shingle)[0]


def bands(hashes: np.ndarray) -> list[int]:
    """A key for each band; one key for the empty set."""
    if not len(hashes):
        return [xxhash.xxh64_intdigest(b"", BANDS) - (1 << 63)]
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), 2048):
        x = hashes[start : start + 2048] * _FACTORS[:, None]
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        np.minimum(least, x.min(1), out=least)
    return [xxhash.xxh64_intdigest(row.tobytes(), i) - (1 << 63) for i, row in enumerate(least.reshape(BANDS, ROWS))]


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Shared shingles by all shingles of both; two empty sets are equal."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared) if len(a) + len(b) else 1.0


def _signatures(texts: DataFrame, shingle: int) -> DataFrame:
    """``(node, n, fingerprint, keys)`` of each distinct text: shingles, SimHash, bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).to_pylist()
            sets, prints = zip(*(described(t, shingle) for t in values)) if values else ((), ())
            columns = [
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(np.array(prints, np.uint64).view(np.int64)),
                pa.array([bands(s) for s in sets], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "fingerprint", "keys"])

    every = texts.mapInArrow(run, "node binary, n long, fingerprint long, keys array<long>")
    # Equal texts are folded before the shuffle.
    return every.groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "fingerprint", "keys")])


def _checked(pairs: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """Those of the distinct ``pairs(a, b)`` whose texts have at least the similarity."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_a, last_b = (None, None), (None, None)
        for batch in batches:
            a, b, text_a, text_b = (batch.column(i).to_pylist() for i in range(4))
            keep = np.zeros(len(a), bool)
            for i in range(len(a)):
                if last_a[0] != a[i]:
                    last_a = a[i], shingles(text_a[i], shingle)
                if last_b[0] != b[i]:
                    last_b = b[i], shingles(text_b[i], shingle)
                keep[i] = similarity(last_a[1], last_b[1]) >= least
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(run, "a binary, b binary")


def groups(df: DataFrame, text: str = "text", shingle: int = 5, least: float = 0.8, distance: int = 4) -> DataFrame:
    """``(node, root)`` for every distinct text: ``node`` as ``node_of`` gives it, ``root`` the smallest that links reach.

    Texts are linked where they share at least ``least`` of their distinct shingles (A-Z lower-cased), null as the empty
    text. Candidates are texts whose SimHashes differ in at most ``distance`` bits and texts that share a band; SimHash
    alone would need 17 bits and more of 64 at 0.8, where pigeonring's segments are 3 bits wide and choose nothing.
    No candidate becomes a link unchecked.

    First each text is checked with the smallest of its band, so a group of copies isn't all of its pairs. Texts whose SimHashes are
    reached from each other by such steps are a band as well. A band that still holds several classes is compared across them if it
    has at most ``WIDE`` texts. The texts of all wider ones, such as those that hold one passage, go through ``_across``, which finds
    every pair of two classes that reaches ``least``: so a pair that shares a band is in one class, or was compared, or can't reach it.

    Texts are told apart by 128 bits of a digest. Null and empty texts are one class, as all texts without a word are.
    """
    prepare(df.sparkSession)
    texts = df.select(node_of(text).alias("node"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))
    known = stored(_signatures(texts, shingle), "signatures")
    prints = stored(known.groupBy("fingerprint").agg(F.min("node").alias("least")), "fingerprints")
    equal = known.join(prints, "fingerprint").select("node", "least")
    near = stored(simhash.links(prints.select("fingerprint"), distance).select("a", "b"), "links-of-fingerprints")
    first, second = (prints.select(F.col("fingerprint").alias(c), F.col("least").alias(f"node_{c}")) for c in "ab")
    reached = connected(near).select(F.col("node").alias("fingerprint"), F.col("root").alias("first"))
    near = near.join(first, "a").join(second, "b").select(F.col("node_a").alias("node"), F.col("node_b").alias("least"))
    alike = stored(_ordered(equal.unionAll(near).filter("node <> least"), "node", "least"), "pairs-of-fingerprints")

    key = F.xxhash64(F.lit("fingerprint"), F.coalesce("first", "fingerprint")).alias("key")
    printed = known.join(reached, "fingerprint", "left").select("node", "n", key)
    members = stored(_shared(known.select("node", "n", F.explode("keys").alias("key")).unionAll(printed)), "band-members")

    # Texts are moved once, and only those stay that some candidate pair may name.
    named = members.select("node").unionAll(alike.select(F.col("a").alias("node"))).unionAll(alike.select(F.col("b").alias("node")))
    needed = stored(texts.join(named.distinct(), "node", "left_semi").dropDuplicates(["node"]), "texts-needed")

    def checked(pairs: DataFrame, name: str) -> DataFrame:
        return stored(_checked(stored(pairs.distinct(), f"pairs-{name}"), needed, shingle, least), f"links-{name}")

    star = members.filter("node <> least.node").filter(_may_reach(F.col("n"), F.col("least.n"), least))
    links = checked(_ordered(star.select("node", F.col("least.node").alias("least")), "node", "least").unionAll(alike), "star")
    classes = stored(connected(links), "text-classes-star")
    several = stored(_open(members, classes), "members-open")
    narrow = several.filter(F.col("size") <= WIDE)
    a, b = (narrow.select("key", F.col("root").alias(f"root_{c}"), F.col("node").alias(c), F.col("n").alias(f"n_{c}")) for c in "ab")
    across = a.join(b, "key").filter(F.col("root_a") < F.col("root_b")).filter(_may_reach(F.col("n_a"), F.col("n_b"), least))
    classes = stored(_joined(classes, checked(_ordered(across.select("a", "b"), "a", "b"), "narrow")), "text-classes")

    # Links within narrow bands have closed some of the wide ones.
    wide = _open(several.filter(F.col("size") > WIDE).select("key", "node", "n"), classes)
    wide = stored(wide.select("node", "n", "root").distinct(), "members-wide")
    if not wide.isEmpty():
        pairs = _across(stored(wide.join(needed, "node"), "texts-wide"), shingle, least)
        classes = stored(_joined(classes, checked(pairs, "wide")), "text-groups")
    return known.select("node").join(classes, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def _across(texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """Pairs ``(a, b)`` of the distinct ``texts(node, n, root, text)`` with different roots: all that reach ``least``, and some more.

    Prefix filtering: in one order of all shingles, two sets that share so much share one of their first ``n - least * n + 1``. Any order
    will do; rare shingles first keeps the texts apart that have a common passage and words of their own. The order is by a count
    of hash buckets, a table of bounded size, and then by the hash. A shingle's texts are compared in chunks, so no task holds them all.
    """
    spark = texts.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << _BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                np.add.at(total, _bucket(shingles(text, shingle)), 1)
        bucket = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(total[bucket])], ["bucket", "n"])

    counted = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << _BUCKETS, np.int64)
    counts[counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    shared = spark.sparkContext.broadcast(counts)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            for i, text in enumerate(batch.column(3).to_pylist()):
                tokens, places = _prefix(shingles(text, shingle), counts, least)
                row = np.full(len(tokens), i)
                columns = [pa.array(tokens.view(np.int64)), pa.array(places), *(batch.column(c).take(pa.array(row)) for c in range(3))]
                yield pa.RecordBatch.from_arrays(columns, ["token", "place", "node", "n", "root"])

    held = texts.select("node", "n", "root", "text").mapInArrow(prefixes, "token long, place long, node binary, n long, root binary")
    held = stored(held, "prefixes")
    # The texts of a shingle's largest class only meet the others, which are few where many copies of one text have it.
    counted = held.groupBy("token", "root").agg(F.count("*").alias("n"))
    several = counted.groupBy("token").agg(F.sum("n").alias("all"), F.max(F.struct("n", "root")).alias("most")).filter(F.col("all") > F.col("most.n"))
    chunks = [F.ceil(n / _CHUNK).cast("int").alias(c) for n, c in ((F.col("all") - F.col("most.n"), "of_a"), (F.col("all"), "of_b"))]
    held = stored(held.join(several.select("token", F.col("most.root").alias("main"), *chunks), "token"), "prefixes-shared")
    digest, columns = F.xxhash64("node"), ("node", "n", "root", "place")
    x, y = (F.pmod(digest, F.col(c)).cast("int") for c in ("of_a", "of_b"))
    every_x, every_y = (F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in ("of_a", "of_b"))
    a = held.filter("root <> main").select("token", "main", x.alias("x"), every_y.alias("y"), *[F.col(c).alias(f"{c}_a") for c in columns])
    b = held.select("token", every_x.alias("x"), y.alias("y"), *[F.col(c).alias(f"{c}_b") for c in columns])
    pairs = a.join(b, ["token", "x", "y"]).filter("root_a < root_b or root_b = main")
    pairs = pairs.filter(_may_reach(F.col("n_a"), F.col("n_b"), least))
    # Of the first shingle that two sets share: what comes after it in either is all that they can share besides.
    most = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    pairs = pairs.filter(most >= F.lit(least / (1 + least)) * (F.col("n_a") + F.col("n_b")) - 1e-6)
    return _ordered(pairs, "node_a", "node_b")


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - _BUCKETS)).astype(np.int64)


def _prefix(hashes: np.ndarray, counts: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Of a set's first shingles, rare ones first, those that another text may have, and their places."""
    often = counts[_bucket(hashes)]
    order = np.lexsort((hashes, often))[: len(hashes) - math.ceil(least * len(hashes) - 1e-9) + 1]
    places = np.flatnonzero(often[order] > 1)
    return hashes[order[places]], places


def _shared(keyed: DataFrame) -> DataFrame:
    """``(key, node, n, least)`` of the keys that several texts have, with the smallest of these texts."""
    smallest = F.min(F.struct("node", "n")).alias("least")
    several = keyed.groupBy("key").agg(smallest, F.max("node").alias("most")).filter(F.col("least.node") < F.col("most"))
    return keyed.join(several.select("key", "least"), "key").select("key", "node", "n", "least")


def _open(members: DataFrame, classes: DataFrame) -> DataFrame:
    """``(key, node, n, root, size)`` of the keys whose texts are of several classes."""
    placed = members.join(classes, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("root"))
    keys = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"))
    return placed.join(keys.filter("low < high").select("key", "size"), "key")


def _joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """The classes that further links make of ``classes(node, root)``: one link a node stands for all that were followed before."""
    return connected(classes.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(links))


def _may_reach(n: Column, m: Column, least: float) -> Column:
    """A set has at least that share of the other's size, or the two can't share so much."""
    return F.least(n, m) >= F.lit(least) * F.greatest(n, m)


def _ordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
    return pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def node_of(text: str) -> Column:
    """What a text is known by: a digest of its bytes."""
    return F.unhex(F.md5(F.coalesce(F.col(text).cast("binary"), F.lit(b""))))
