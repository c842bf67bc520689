"""Secret scans: fixed patterns, and a battery of randomness tests over other long tokens with false-discovery control."""

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.common import prepare, stored

#: Kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "random")
MIN_TOKEN = 20

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more is a match of [0-9a-f]+, and shorter matches are dropped
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}+={0,2}" % MIN_TOKEN)
_IN_TOKEN = np.zeros(256, bool)
_IN_TOKEN[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"]] = True

#: Alphabets from the narrowest; a token's encoding is the first that has all of its symbols.
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = {
    "decimal": _DIGITS,
    "hex": _DIGITS + "abcdef",
    "hex upper": _DIGITS + "ABCDEF",
    "lower": _LOWER,
    "upper": _UPPER,
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "base36 upper": _DIGITS + _UPPER,
    "letters": _UPPER + _LOWER,
    "base62": _UPPER + _LOWER + _DIGITS,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64 url": _UPPER + _LOWER + _DIGITS + "-_",
    "base64 joint": _UPPER + _LOWER + _DIGITS + "+/-_",
}
#: Signs at which a run is also split: it may be a path, or words joined by hyphens or underscores, with a key as one part.
_SPLITS = tuple(re.compile(f"[^{signs}]+") for signs in ("/+", "_-", "/+_-"))
_SIGN = re.compile("[/+_-]")
_SYMBOLS = {name: frozenset(symbols) for name, symbols in ALPHABETS.items()}


def _by_byte(values: dict[str, int]) -> np.ndarray:
    out = np.zeros(128, np.int64)
    for symbol, value in values.items():
        out[ord(symbol)] = value
    return out


_PLACE = {name: _by_byte({c: i for i, c in enumerate(symbols)}) for name, symbols in ALPHABETS.items()}
_KIND = {c: i for i, symbols in enumerate((_DIGITS, _LOWER, _UPPER, "+/-_")) for c in symbols}
#: Kinds of symbols (digits, lower, upper, signs) of each alphabet, and how often neighbours differ in kind in a patterned
#: token: in words, numbers and identifiers of one case at most every fifth time, in CamelCase with numbers every second time.
_KINDS_OF = {name: {_KIND[c] for c in symbols} for name, symbols in ALPHABETS.items()}
_KIND_OF_BYTE = _by_byte(_KIND)
_CHANGES = {name: 0.2 if not {1, 2} <= kinds else 0.5 for name, kinds in _KINDS_OF.items()}
_SAME_KIND = {
    name: sum((sum(_KIND[c] == kind for c in ALPHABETS[name]) / len(ALPHABETS[name])) ** 2 for kind in kinds) for name, kinds in _KINDS_OF.items()
}
_REJECT = 1e-3
_BINS_A_DECADE, _BINS = 20, 800


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the patterns' matches, ends exclusive, in code points, ordered by start and kind."""
    spans = []
    if "=" in text or ":" in text:
        spans += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    spans += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], s[2]))


def _normal(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _chi_root(x: float, freedom: float, shift: float) -> float:
    """z of a (noncentral) chi-squared value, by the cube-root approximation."""
    a, b = freedom + shift, shift / (freedom + shift)
    v = 2 / 9 * (1 + b) / a
    return ((x / a) ** (1 / 3) - (1 - v)) / math.sqrt(v)


def encoding(token: str) -> str | None:
    symbols = set(token)
    return next((name for name, known in _SYMBOLS.items() if symbols <= known), None)


def _fisher(*chances: float) -> float:
    """One p-value of several independent ones."""
    half = -sum(math.log(max(p, 1e-300)) for p in chances)
    return math.exp(-half) * sum(half**i / math.factorial(i) for i in range(len(chances)))


def surprise(token: str) -> float:
    """How unlikely it is that a patterned token of this length looks as random as this one: a p-value, 1 if it is no candidate.

    Three tests against uniform, independent symbols of the inferred alphabet: chi-squared of the symbol counts; runs, of
    digits, lower and upper letters and signs, or, in an alphabet of one such kind, above and below its middle; correlation of
    neighbours. Where Fisher's combination rejects randomness, or for plain numbers, the answer is 1. Otherwise it combines,
    in the same way, the chances that a patterned token does as well: that symbols as unequal as letters of a language (sum
    of squared shares 0.0655) reach a chi-squared value as low, and, where the alphabet has several kinds, that words,
    numbers and identifiers change between kinds as often. Both fall with the length, so short tokens, of which the tests
    can't say much, need not be excluded by rule.
    """
    token = token.rstrip("=")
    name = encoding(token)
    if name is None or name == "decimal" or len(token) < MIN_TOKEN:
        return 1.0
    symbols, k, n = np.frombuffer(token.encode(), np.uint8), len(ALPHABETS[name]), len(token)
    x = _PLACE[name][symbols]
    counts = np.bincount(x, minlength=k)
    chi = float(counts @ counts) * k / n - n
    uniform = 1 - _normal(_chi_root(chi, k - 1, 0.0))
    several = len(_KINDS_OF[name]) > 1
    kind = _KIND_OF_BYTE[symbols] if several else x >= k / 2
    changes, expected = int(np.count_nonzero(kind[1:] != kind[:-1])), 1 - _SAME_KIND[name] if several else 0.5
    runs = math.erfc(abs(changes - (n - 1) * expected) / math.sqrt((n - 1) * expected * (1 - expected)) / math.sqrt(2))
    centred = x - (k - 1) / 2
    serial = math.erfc(abs(float(centred[1:] @ centred[:-1])) / ((k * k - 1) / 12 * math.sqrt(n - 1)) / math.sqrt(2))
    if _fisher(uniform, runs, serial) < _REJECT:
        return 1.0
    even = _normal(_chi_root(chi, k - 1, n * max(0.7, 0.0655 * k - 1)))
    if not several:
        return even
    rate = _CHANGES[name]
    return _fisher(even, _normal(((n - 1) * rate - changes + 0.5) / math.sqrt((n - 1) * rate * (1 - rate))))


def _bin(p: float) -> int:
    """Bin of a p-value, rounded to the larger p."""
    return min(_BINS - 1, int(-math.log10(max(p, 1e-40)) * _BINS_A_DECADE))


def length_class(n: int) -> int:
    """Lengths from 20, 24, 32, 48, 64, 128 and 1,024 on are judged among themselves."""
    return sum(n >= x for x in (24, 32, 48, 64, 128, 1024))


def random_tokens(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, end, length class, bin of the p-value) of every token that no span of ``taken``, sorted by start, overlaps.

    A run of token characters is read whole, split at ``/+``, at ``_-`` and at all four; what counts is the reading with the
    smallest p-value (the longest parts among equal ones), which is multiplied by the number of candidates in the run.
    """
    starts, ends = [s for s, _, _ in taken], list(accumulate((e for _, e, _ in taken), max))

    def free(start: int, end: int) -> bool:
        before = bisect_left(starts, end)
        return end - start >= MIN_TOKEN and (not before or ends[before - 1] <= start)

    found = []
    for m in _TOKEN.finditer(text):
        at, run = m.start(), m.group()
        readings = [[(at, m.end())]]
        if _SIGN.search(run):
            readings += [[(at + part.start(), at + part.end()) for part in split.finditer(run)] for split in _SPLITS]
        readings = [[span for span in spans if free(*span)] for spans in readings]
        p = {span: surprise(text[span[0] : span[1]]) for span in dict.fromkeys(span for spans in readings for span in spans)}
        best = min((spans for spans in readings if spans), key=lambda spans: min(p[s] for s in spans), default=[])
        found += [(start, end, length_class(end - start), _bin(min(1.0, p[start, end] * len(p)))) for start, end in best]
    return found


def suspects(texts: list[bytes | None]) -> np.ndarray:
    """Rows that can hold a span: a run of 20 token characters, or an assignment's word and sign."""
    data = np.frombuffer(b" ".join(t or b"" for t in texts), np.uint8)
    ends = np.cumsum([len(t or b"") + 1 for t in texts])
    out = np.zeros(len(texts), bool)
    breaks = np.flatnonzero(~_IN_TOKEN[data])
    edges = np.concatenate([[-1], breaks, [len(data)]])
    out[np.searchsorted(ends, edges[:-1][np.diff(edges) > MIN_TOKEN] + 1, "right")] = True
    for i, t in enumerate(texts):
        if t and not out[i] and (b"=" in t or b":" in t):
            low = t.lower()
            out[i] = any(word in low for word in (b"passw", b"secret", b"token", b"api"))
    return out


_SPAN = T.StructType([T.StructField(n, T.IntegerType()) for n in ("start", "end", "kind")])
_TOKENS = T.StructType([T.StructField(n, T.IntegerType()) for n in ("start", "end", "lengths", "bin")])


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, spans, tokens)``: the patterns' spans and the other tokens with their p-values' bins. Null texts count as empty."""
    prepare(df.sparkSession)
    chosen = df.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("text"))
    schema = T.StructType(
        [chosen.schema["id"], T.StructField("spans", T.ArrayType(_SPAN)), T.StructField("tokens", T.ArrayType(_TOKENS))]
    )
    kinds = [pa.list_(pa.struct([(f.name, pa.int32()) for f in t.fields])) for t in (_SPAN, _TOKENS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            spans, tokens = [[] for _ in texts], [[] for _ in texts]
            for i in np.flatnonzero(suspects(texts)):
                string = texts[i].decode("utf-8", "replace")
                own = base_spans(string)
                spans[i] = [dict(zip(("start", "end", "kind"), s)) for s in own]
                tokens[i] = [dict(zip(("start", "end", "lengths", "bin"), s)) for s in random_tokens(string, own)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, kinds[0]), pa.array(tokens, kinds[1])], ["id", "spans", "tokens"]
            )

    return chosen.mapInArrow(run, schema)


def thresholds(found: DataFrame, rate: float = 0.01) -> dict[int, int]:
    """For each class of lengths the smallest bin that is a discovery, by Benjamini and Hochberg over all tokens of the class.

    What the driver gets are counts of 7 * 800 bins at most, whatever the number of documents.
    """
    counts: dict[int, np.ndarray] = {}
    rows = found.select(F.explode("tokens").alias("t")).groupBy("t.lengths", "t.bin").count().collect()
    for lengths, at, n in rows:
        counts.setdefault(lengths, np.zeros(_BINS, np.int64))[at] += n
    out = {}
    for lengths, n in counts.items():
        reached = n[::-1].cumsum()[::-1]
        largest = 10.0 ** (-np.arange(_BINS) / _BINS_A_DECADE)
        fits = np.flatnonzero((reached > 0) & (largest * n.sum() <= rate * reached))
        if len(fits):
            out[lengths] = int(fits[0])
    return out


def secrets(found: DataFrame, limits: dict[int, int]) -> DataFrame:
    """``(id, spans)`` with array<struct<start, end, kind>> by start and kind: the patterns' spans and the discoveries."""
    # The limits are at most seven numbers; -1 never occurs as a class.
    limit = F.create_map(*[F.lit(x) for pair in {-1: _BINS, **limits}.items() for x in pair])
    random = F.transform(
        F.filter("tokens", lambda t: F.coalesce(t["bin"] >= limit[t["lengths"]], F.lit(False))),
        lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.lit(KINDS.index("random")).alias("kind")),
    )
    order = F.transform(
        F.array_sort(F.transform(F.concat("spans", random), lambda s: F.struct(s["start"], s["kind"], s["end"]))),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    return found.select("id", order.alias("spans"))


def find(df: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: float = 0.01) -> DataFrame:
    """The spans of every row: one pass over the texts, then one over what it found.

    Empty and null texts have no span. Repeated rows each return a row. An empty table gives an empty one. Other columns
    are not read.
    """
    found = stored(scan(df, doc_id, text), "secret-candidates")
    return secrets(found, thresholds(found, rate))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redact(df: DataFrame, text: str = "text", rate: float = 0.01, mark: str = "[secret]") -> DataFrame:
    """The same rows and columns with every span of the text replaced by ``mark``; overlapping spans are replaced at once.

    Two passes over the texts instead of a shuffle of them: the first gives the thresholds, the second applies them.
    """
    prepare(df.sparkSession)
    limits = thresholds(scan(df.withColumn("__id", F.lit(0)), "__id", text), rate)
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            hits = np.flatnonzero(suspects(texts))
            clean = batch.column(at).to_pylist() if len(hits) else None
            for i in hits:
                string = clean[i]
                own = base_spans(string)
                own += [(s, e, 3) for s, e, n, b in random_tokens(string, own) if b >= limits.get(n, _BINS)]
                parts, last = [], 0
                for start, end, _ in sorted(own):
                    if start >= last:
                        parts += [string[last:start], mark]
                    last = max(last, end)
                clean[i] = "".join([*parts, string[last:]])
            columns = list(batch.columns)
            if clean is not None:
                columns[at] = pa.array(clean, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return df.mapInArrow(run, df.schema)
