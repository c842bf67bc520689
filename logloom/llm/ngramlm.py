"""Texts scored by a trigram model that is kept in Elias-Fano tries, one per shard of first words."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from logloom.llm.common import prepare, stored, word_chunks
from logloom.llm.eliasfano import Trie, dequantise

#: Text of a block, and tokens of a shard: what a task holds at once, whatever the size of the corpus.
BLOCK_BYTES, SHARD_TOKENS = 20 << 20, 1 << 20
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_END, _BEGIN, _NONE = 0, 0, -1  # local number of the closing token; ids of the opening one and of no word or an unknown one


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers of one length, byte planes apart, compressed."""
    parts = [np.array([len(arrays[0]), *(a.dtype.itemsize for a in arrays)], "<i8").tobytes()]
    for a in arrays:
        parts.append(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpacked(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n, at, out = int(np.frombuffer(raw, "<i8", 1)[0]), 8 * (1 + len(kinds)), []
    for kind in kinds:
        size = n * np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, size, at).reshape(np.dtype(kind).itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(-1))
        at += size
    return out


class _Numbers(dict):
    """Numbers of words in the order of their first use; 0 is the closing token's."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self) + 1
        return found


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit number of each."""
    x = np.asarray(x).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _distinct(*columns: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows in rising order, and each row's place among them. A row becomes one number; where values are too large for
    that, they are replaced by their ranks first."""
    columns, values = list(columns), [None] * len(columns)
    low = [int(c.min()) if len(c) else 0 for c in columns]
    sizes = [int(c.max()) - m + 1 if len(c) else 1 for c, m in zip(columns, low)]
    for i in range(len(columns)):
        if math.prod(sizes) >= 1 << 62:
            values[i], columns[i] = np.unique(columns[i], return_inverse=True)
            low[i], sizes[i] = 0, len(values[i])
    if math.prod(sizes) >= 1 << 62:
        raise ValueError("too many different values in one block")
    code = np.zeros(len(columns[0]), np.int64)
    for c, m, size in zip(columns, low, sizes):
        code *= size
        code += c
        code -= m
    code, inverse = np.unique(code, return_inverse=True)
    out = []
    for v, m, size in zip(values[::-1], low[::-1], sizes[::-1]):
        code, c = np.divmod(code, size)
        out.append(c + m if v is None else v[c])
    return out[::-1], inverse.reshape(-1)


def _summed(inverse: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of whole numbers; exact below 2^53, which no count passes."""
    return np.bincount(inverse, values, size).astype(np.int64)


def tokenised(df: DataFrame, doc_id: str, text: str, train: Column) -> DataFrame:
    """Blocks of texts as one row each: ids, token numbers within the block, and digests (in rising order) and training counts of its words; written."""
    chosen = df.select(
        F.col(doc_id).alias("id"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"), F.coalesce(train, F.lit(False)).alias("train")
    )

    def block(number: int, ids: list, texts: list[np.ndarray], train: list[bool], words: _Numbers) -> pa.RecordBatch:
        sizes = np.array([len(t) for t in texts], np.int64)
        tokens = np.concatenate(texts)
        learned = np.repeat(np.array(train, bool), sizes)
        counts = np.bincount(tokens[learned], minlength=len(words) + 1).astype(np.int64)
        digests = np.frombuffer(b"\0" * 16 + b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(-1, 2)
        order = np.argsort(digests[:, 0], kind="stable")
        digests = digests[order]
        row = {
            "block": pa.array([(TaskContext.get().partitionId() << 32) + number], pa.int64()),
            "ids": pa.array([ids], pa.list_(kind)),
            "sizes": pa.array([packed(sizes, np.array(train, np.int8))]),
            "tokens": pa.array([packed(tokens)]),
            "order": pa.array([packed(order.astype(np.uint32))]),
            "words": pa.array([packed(digests[:, 0], digests[:, 1].astype(np.uint32), counts[order])]),
            "n_tokens": pa.array([len(tokens)], pa.int64()),
            "n_learned": pa.array([sum(train)], pa.int64()),
        }
        return pa.RecordBatch.from_arrays(list(row.values()), list(row))

    kind = to_arrow_type(chosen.schema["id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = 0, 0
        ids, texts, train, words = [], [], [], _Numbers()
        for batch in batches:
            for i, t, learn in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if texts and held + len(t) > BLOCK_BYTES:
                    yield block(number, ids, texts, train, words)
                    number, held = number + 1, 0
                    ids, texts, train, words = [], [], [], _Numbers()
                numbers = [np.fromiter(map(words.__getitem__, c.split()), np.uint32) for c in word_chunks(t.translate(_LOWER))]
                texts.append(np.concatenate([*numbers, np.zeros(1, np.uint32)]))
                ids.append(i)
                train.append(learn)
                held += len(t)
        if texts:
            yield block(number, ids, texts, train, words)

    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("ids", T.ArrayType(chosen.schema["id"].dataType)),
            *(T.StructField(n, T.BinaryType()) for n in ("sizes", "tokens", "order", "words")),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_learned", T.LongType()),
        ]
    )
    return stored(chosen.mapInArrow(run, schema), "token-blocks")


def _vocabulary(blocks: DataFrame, shards: int) -> DataFrame:
    """Replies ``(block, shard, ids, figures)``: for the block's words of that shard an id (-1: not learned) and its count over
    all training texts. ``figures`` (tokens, distinct words, words seen once, twice) stands in one row of each shard, with no block.

    Ids are small for frequent words: the rank within the shard times the number of shards, plus the shard.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                first, second, counts = unpacked(data, "<u8", "<u4", "<i8")
                shard = ((first >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
                cuts = np.flatnonzero(np.diff(shard, prepend=-1, append=shards))
                parts = [slice(a, b) for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard[p.start] for p in parts], pa.int32()),
                        pa.array([number] * len(parts), pa.int64()),
                        pa.array([packed(first[p], second[p], counts[p]) for p in parts], pa.binary()),
                    ],
                    ["shard", "block", "words"],
                )

    def merge(table: pa.Table) -> pa.Table:
        shard, numbers = table["shard"][0].as_py(), table["block"].to_pylist()
        parts = [unpacked(d.as_py(), "<u8", "<u4", "<i8") for d in table["words"]]
        first, second, counts = (np.concatenate(c) for c in zip(*parts))
        by_digest = np.lexsort((second, first))
        new = (np.diff(first[by_digest], prepend=first[:1]) != 0) | (np.diff(second[by_digest], prepend=second[:1]) != 0)
        inverse = np.empty(len(first), np.int64)
        inverse[by_digest] = np.cumsum(new)
        total = _summed(inverse, counts, int(new.sum()) + 1)
        rank = np.empty(len(total), np.int64)
        rank[np.argsort(-total, kind="stable")] = np.arange(len(total))
        ids = np.where(total > 0, rank * shards + shard + 1, _NONE)
        ends = np.cumsum([len(p[0]) for p in parts])
        replies = [packed(ids[i], total[i]) for i in np.split(inverse, ends[:-1])]
        figures = [int(total.sum()), int((total > 0).sum()), int((total == 1).sum()), int((total == 2).sum())]
        return pa.table(
            {
                "block": pa.array([*numbers, None], pa.int64()),
                "shard": pa.array([shard] * (len(numbers) + 1), pa.int32()),
                "ids": pa.array([*replies, None], pa.binary()),
                "figures": pa.array([None] * len(numbers) + [figures], pa.list_(pa.int64())),
            }
        )

    dealt = blocks.select("block", "words").mapInArrow(deal, "shard int, block long, words binary")
    return stored(dealt.groupBy("shard").applyInArrow(merge, "block long, shard int, ids binary, figures array<long>"), "word-replies")


def _words_of(block: dict, replies: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Id and count of each word of a block by its number, put together from the replies; shards and digests rise alike."""
    order = unpacked(block["order"], "<u4")[0]
    found = [unpacked(replies[s], "<i8", "<i8") for s in sorted(replies)]
    ids, counts = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    ids[order], counts[order] = (np.concatenate(c) for c in zip(*found))
    return ids, counts


def _asked(block: dict, ids: np.ndarray, counts: np.ndarray, shards: int, learned: int):
    """What a block has to know of the model: ``(u, v, w)`` of each token v, its predecessor and its successor, distinct, by shard.

    Returns the distinct rows with the count of u, their shards, each token's place among the rows, and the number of training tokens of each row.
    A shard is known by its first word. A first word with more tokens than a shard takes is dealt by its second word as
    well, in shards of their own above the others; a row (u, none, none) goes to each of them for the part of u's weight there.
    """
    sizes, train = unpacked(block["sizes"], "<i8", "<i1")
    tokens = unpacked(block["tokens"], "<u4")[0].astype(np.int64)
    ends = np.cumsum(sizes)
    # Numbers within the block stand for ids; unknown words share one, and two more are for no word and for the beginning.
    none, begin = len(ids), len(ids) + 1
    tokens = np.where(ids == _NONE, none, np.arange(len(ids)))[tokens]
    ids, counts = np.append(ids, [_NONE, _BEGIN]), np.append(counts, [0, learned])
    u = np.concatenate([[begin], tokens[:-1]])
    u[ends[:-1]] = begin
    # Nothing is known behind an unknown word.
    w = np.where(tokens == none, none, np.append(tokens[1:], none))
    w[ends - 1] = none
    (u, v, w), inverse = _distinct(u, tokens, w)
    n = _summed(inverse, np.repeat(train, sizes), len(u))
    split = np.maximum(-(-counts // SHARD_TOKENS), 1)

    def shard_of(u: np.ndarray, part: np.ndarray) -> np.ndarray:
        here = (_mixed(ids[u] * 1_000_003 + part) % np.uint64(shards)).astype(np.int64)
        # No shard is asked for what follows an unknown word.
        return np.where(u == none, 2 * shards, here + np.where(split[u] > 1, shards, 0))

    shard = shard_of(u, (_mixed(ids[v]) % split[u].astype(np.uint64)).astype(np.int64))
    hot = np.unique(u[(split[u] > 1) & (u != none)])
    words = np.repeat(hot, split[hot])
    part = np.arange(len(words)) - np.repeat(np.cumsum(split[hot]) - split[hot], split[hot])
    (extra, extra_shard), _ = _distinct(words, shard_of(words, part))
    known = len(u)
    u, v, w = (np.concatenate(c) for c in ((u, extra), (v, np.full(len(extra), none)), (w, np.full(len(extra), none))))
    n, shard = np.append(n, np.zeros(len(extra), np.int64)), np.append(shard, extra_shard)
    order = np.argsort(shard, kind="stable")
    place = np.empty(len(u), np.int64)
    place[order] = np.arange(len(u))
    rows = ids[u[order]], ids[v[order]], ids[w[order]], counts[u[order]]
    return rows, shard[order], place[inverse], place[known:], n[order]


def _requests(blocks: DataFrame, replies: DataFrame, shards: int, learned: int) -> DataFrame:
    """``(shard, block, rows)``: the distinct (u, v, w) that a block asks a shard for, with their training counts."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        shard_of, number_of, data = [], [], []
        for block in left.to_pylist():
            known = dict(zip(right["shard"].to_pylist(), right["ids"].to_pylist()))
            rows, shard, _, _, n = _asked(block, *_words_of(block, known), shards, learned)
            cuts = np.searchsorted(shard, np.arange(2 * shards + 1))
            for s in np.flatnonzero(np.diff(cuts)):
                at = slice(cuts[s], cuts[s + 1])
                shard_of.append(s)
                number_of.append(block["block"])
                data.append(packed(*(c[at] for c in rows), n[at]))
        return pa.table({"shard": pa.array(shard_of, pa.int32()), "block": pa.array(number_of, pa.int64()), "rows": pa.array(data, pa.binary())})

    back = replies.filter("block is not null").select("block", "shard", "ids").groupBy("block")
    return _travelling(blocks).cogroup(back).applyInArrow(run, "shard int, block long, rows binary")


def _travelling(blocks: DataFrame):
    """What of the blocks meets the replies, in the same columns each time, so that Spark moves it once."""
    return blocks.select("block", "ids", "sizes", "tokens", "order").groupBy("block")


def discount(once: int, twice: int) -> float:
    """What is taken off every count, n1 / (n1 + 2 n2), between 0.1 and 0.9; 0.5 where nothing occurs once or twice."""
    return min(max(once / (once + 2 * twice), 0.1), 0.9) if once + twice else 0.5


def _trie(u: np.ndarray, v: np.ndarray, w: np.ndarray, total: np.ndarray, n: np.ndarray, whole: bool, discounts) -> bytes:
    """The trie of a shard's distinct rows with their training counts; ``total`` is the count of u where the shard isn't ``whole``."""
    seen = n > 0
    u, v, w, total, n = (c[seen] for c in (u, v, w, total, n))
    (u2, v2), inverse = _distinct(u, v)
    n2, most = _summed(inverse, n, len(u2)), np.zeros(len(u2), np.int64)
    most[inverse] = total
    more = w != _NONE
    third, n3 = np.stack([u[more], v[more], w[more]], 1), n[more]
    d2, d3 = discounts or (discount(int((c == 1).sum()), int((c == 2).sum())) for c in (n2, n3))
    first, of = np.unique(u2, return_inverse=True)
    total_1, types_1 = _summed(of, n2, len(first)), np.bincount(of, minlength=len(first))
    if not whole:
        total_1[of] = most
    second = np.stack([u2, v2], 1)
    pairs = Trie.pairs(second, third)
    total_2, types_2 = _summed(pairs, n3, len(u2)), np.bincount(pairs, minlength=len(u2))
    p = {
        "weight_1": d2 * types_1 / np.maximum(total_1, 1),
        "p_2": (n2 - d2) / np.maximum(total_1[of], 1),
        "weight_2": d3 * types_2 / np.maximum(total_2, 1),
        "p_3": (n3 - d3) / np.maximum(total_2[pairs], 1),
    }
    return Trie.build(second, third, p)


def _answered(requests: DataFrame, shards: int, discounts) -> DataFrame:
    """``(block, shard, codes)``: the quantised logarithms that a shard's trie has for a block's rows.

    A shard counts the rows of all blocks, builds its trie and asks it for each distinct row once.
    """

    def run(table: pa.Table) -> pa.Table:
        parts = [unpacked(d.as_py(), *["<i8"] * 5) for d in table["rows"]]
        ends = np.cumsum([len(p[0]) for p in parts])
        u, v, w, total, n = (np.concatenate(c) for c in zip(*parts))
        del parts
        rows, inverse = _distinct(u, v, w)
        totals = np.zeros(len(rows[0]), np.int64)
        totals[inverse] = total
        data = _trie(*rows, totals, _summed(inverse, n, len(totals)), table["shard"][0].as_py() < shards, discounts)
        found = Trie.view(data).look_up(np.stack(rows, 1))
        codes = [packed(*(found[name][i] for name in Trie.CODES)) for i in np.split(inverse, ends[:-1])]
        return pa.table({"block": table["block"], "shard": table["shard"], "codes": pa.array(codes, pa.binary())})

    return requests.groupBy("shard").applyInArrow(run, "block long, shard int, codes binary")


def score(
    df: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", discounts: tuple[float, float] | None = None
) -> DataFrame:
    """``(id, n_tokens, n_known, train_tokens, base_score, score)`` of every row of ``df``.

    A-Z are lower-cased; tokens are the words between white space and one closing token. Learned are the rows where ``train`` holds.
    ``base_score`` is the sum of log10((c + 0.5) / (N + 0.5 (V + 1))) with the training count c of each token. ``score`` is the log10 probability
    of the text by an interpolated trigram model with absolute discounting: what a discount takes off the seen n-grams of a
    context goes to the next shorter context, that of single words to V known words and one unknown word alike. The discounts of
    bigrams and trigrams are estimated for each shard of first words, or given as ``discounts``. Probabilities
    are kept as 16-bit logarithms (512 steps a decade), so a token's is within 0.5 % of the unrounded one.

    Every count covers all training texts. Texts are read in blocks; a block asks shards of words for ids and counts, and shards of
    first words for n-grams. A shard is counted, turned into a trie and searched by one task that holds a bounded share of the
    corpus. A first word with more tokens than that is dealt by its second word. No model is broadcast. What stays with one
    task at any size is the list of one pair's distinct successors.

    A null text is an empty one: its closing token is scored. A null in ``train`` means not learned. Repeated rows are rows of their own, null ids
    stay null, a text longer than a block is a block of its own. With nothing to learn from, every token has probability 1.
    An empty table gives an empty result. Words are told apart by 96 bits of a digest. Other columns are not read.
    """
    prepare(df.sparkSession)
    blocks = tokenised(df, doc_id, text, train)
    size = blocks.agg(F.sum("n_tokens"), F.sum("n_learned")).first()
    shards, learned = max(1, math.ceil((size[0] or 0) / SHARD_TOKENS)), size[1] or 0
    replies = _vocabulary(blocks, shards)
    tokens, words, once, twice = _figures(replies)
    answers = _answered(_requests(blocks, replies, shards, learned), shards, discounts)
    d1 = discount(once, twice)
    spread = d1 * words / tokens / (words + 1) if tokens else 1.0 / (words + 1)
    floor = tokens + 0.5 * (words + 1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for block in left.to_pylist():
            kinds, shard_of, data = right["kind"].to_pylist(), right["shard"].to_pylist(), right["data"].to_pylist()
            ids, counts = _words_of(block, {s: d for k, s, d in zip(kinds, shard_of, data) if k == 0})
            answer = {s: d for k, s, d in zip(kinds, shard_of, data) if k == 1}
            rows, shard, place, extra, _ = _asked(block, ids, counts, shards, learned)
            codes = [unpacked(answer[s], *["<u2"] * 4) for s in sorted(answer)]
            rest = np.zeros(int((shard == 2 * shards).sum()), np.uint16)
            weight_1, p_2, weight_2, p_3 = (np.concatenate([*(c[i] for c in codes), rest]) for i in range(4))
            # The weight of a word that is dealt over several shards is the sum of its parts.
            left_1 = dequantise(weight_1, 1.0)
            hot, of = np.unique(rows[0][extra], return_inverse=True)
            if len(hot):
                sums = np.bincount(of, dequantise(weight_1[extra]))
                dealt = np.flatnonzero((shard >= shards) & (shard < 2 * shards))
                left_1[dealt] = sums[np.searchsorted(hot, rows[0][dealt])]
            left_1, p_2, weight_2, p_3 = (c[place] for c in (left_1, p_2, weight_2, p_3))
            sizes = unpacked(block["sizes"], "<i8", "<i1")[0]
            starts = np.cumsum(sizes) - sizes
            c = counts[unpacked(block["tokens"], "<u4")[0]]
            # A token's trigram is the row of the token before; a text's first token has none.
            weight_2, p_3 = np.concatenate([[0], weight_2[:-1]]), np.concatenate([[0], p_3[:-1]])
            weight_2[starts], p_3[starts] = 0, 0
            p = np.where(c > 0, (c - d1) / max(tokens, 1), 0) + spread
            p = dequantise(p_2) + left_1 * p
            p = dequantise(p_3) + dequantise(weight_2, 1.0) * p
            sums = [np.add.reduceat(x, starts) for x in ((c > 0).astype(np.int64), np.log10((c + 0.5) / floor), np.log10(np.minimum(p, 1)))]
            out.append(pa.table({"id": left["ids"].combine_chunks().flatten(), "n_tokens": sizes, "n_known": sums[0], "base_score": sums[1], "score": sums[2]}))
        return pa.concat_tables(out)

    back = replies.filter("block is not null").select("block", F.lit(0).alias("kind"), "shard", F.col("ids").alias("data")).unionAll(
        answers.select("block", F.lit(1), "shard", "codes")
    )
    schema = T.StructType(
        [
            T.StructField("id", df.select(F.col(doc_id)).schema[0].dataType),
            *(T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known")),
            *(T.StructField(n, T.DoubleType()) for n in ("base_score", "score")),
        ]
    )
    scored = _travelling(blocks).cogroup(back.groupBy("block")).applyInArrow(run, schema)
    return scored.select("id", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")


def _figures(df: DataFrame) -> list[int]:
    """Sums of the four numbers that each shard notes."""
    row = df.filter("figures is not null").agg(*[F.sum(F.col("figures")[i]) for i in range(4)]).first()
    return [v or 0 for v in row]
