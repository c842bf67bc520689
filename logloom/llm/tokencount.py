"""Token counts by finite-state transducers compiled from a byte-level BPE vocabulary.

Two deterministic machines: one over character classes marks where the splitting pattern begins a new stretch, one over bytes
annotates its transitions with the number of tokens that the merges add. The first runs over all texts of a batch at once,
in chunks whose state maps are composed by a parallel prefix scan; the second starts anew at each stretch, so what a whole
stretch adds is a composed transition of its own, and is kept.
"""

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.common import Memo, blocks, prepare

# Character classes of the splitting pattern
#   's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
_OTHER, _LETTER, _NUMBER, _BLANK, _SPACE, _QUOTE, _ONE, _R, _V, _E, _L = range(11)
_CLASSES = 11
#: Characters of the Unicode property White_Space.
WHITE_SPACE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# States: what the stretch in progress is. W* are white space: one or more characters, the last of them a blank or not.
_START, _LETTERS, _NUMBERS, _OTHERS, _W1, _X1, _WN, _XN, _Q, _QR, _QV, _QL = range(12)
_STATES = 12
#: Outputs: a stretch begins at this character; one begins at the character before.
_HERE, _BEFORE = 1, 2


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point, from its Unicode category."""
    out = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            out[code] = _LETTER
        elif kind == "N":
            out[code] = _NUMBER
    out[WHITE_SPACE] = _SPACE
    out[32], out[39] = _BLANK, _QUOTE
    for c in "stmd":
        out[ord(c)] = _ONE
    out[ord("r")], out[ord("v")], out[ord("e")], out[ord("l")] = _R, _V, _E, _L
    return out


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and output by state and class."""
    run = {c: _LETTERS for c in (_LETTER, _ONE, _R, _V, _E, _L)} | {_NUMBER: _NUMBERS, _OTHER: _OTHERS, _QUOTE: _OTHERS}
    state, out = np.zeros((_STATES, _CLASSES), np.uint8), np.zeros((_STATES, _CLASSES), np.uint8)

    def anew(c: int) -> int:
        """State of a stretch that begins with class c."""
        return {_BLANK: _W1, _SPACE: _X1, _QUOTE: _Q}.get(c, run.get(c))

    for c in range(_CLASSES):
        white = c in (_BLANK, _SPACE)
        state[_START, c], out[_START, c] = anew(c), _HERE
        for s in (_LETTERS, _NUMBERS, _OTHERS):
            goes_on = not white and run[c] == s and (c != _QUOTE or s == _OTHERS)
            state[s, c], out[s, c] = (s, 0) if goes_on else (anew(c), _HERE)
        for s in (_W1, _X1, _WN, _XN):
            if white:
                state[s, c], out[s, c] = (_WN if c == _BLANK else _XN), 0
            elif s in (_W1, _WN):  # the blank goes with what follows; in a longer run it leaves the run
                state[s, c], out[s, c] = run[c], _BEFORE if s == _WN else 0
            else:  # the last of the run stands alone
                state[s, c], out[s, c] = anew(c), _HERE | (_BEFORE if s == _XN else 0)
        if c == _ONE:
            state[_Q, c], out[_Q, c] = _START, 0
        elif c in (_R, _V, _L):
            state[_Q, c], out[_Q, c] = {_R: _QR, _V: _QV, _L: _QL}[c], 0
        else:
            state[_Q, c], out[_Q, c] = state[_OTHERS, c], out[_OTHERS, c]
        for s, last in ((_QR, _E), (_QV, _E), (_QL, _L)):
            if c == last:
                state[s, c], out[s, c] = _START, 0
            else:  # no contraction: letters began at the character before
                state[s, c], out[s, c] = state[_LETTERS, c], out[_LETTERS, c] | _BEFORE
    return state, out


_NEXT, _OUT = _machine()


def stretches(kinds: np.ndarray, first: np.ndarray, width: int = 256) -> np.ndarray:
    """Positions at which a stretch begins. ``kinds`` are the classes of all texts in a row, ``first`` where each text begins.

    The characters lie in chunks. Each chunk's map from the state before it to the state after it is built for all states and
    all chunks at once; a prefix scan composes the maps; then every chunk runs from its now known state.
    """
    n = len(kinds)
    if not n:
        return np.zeros(0, np.int64)
    # A text starts anew: an extra class that leads every state to where the class leads from the start.
    anew = np.zeros(n, np.uint8)
    anew[first] = _CLASSES
    symbols = kinds + anew
    chunks = -(-n // width)
    grid = np.full((chunks, width), 2 * _CLASSES, np.uint8)
    grid.reshape(-1)[:n] = symbols
    stay = np.arange(_STATES, dtype=np.uint8)[:, None]
    table = np.hstack([_NEXT, np.repeat(_NEXT[_START : _START + 1], _STATES, 0), stay]).astype(np.uint8)
    # A retroactive start belongs to the text before and is cut off: white space at a text's end is one stretch.
    output = np.hstack([_OUT, np.full((_STATES, _CLASSES), _HERE, np.uint8), np.zeros((_STATES, 1), np.uint8)])
    for s in (_QR, _QV, _QL):
        output[s, _CLASSES : 2 * _CLASSES] |= _BEFORE
    flat, columns = table.reshape(-1), table.shape[1]
    maps = np.repeat(np.arange(_STATES, dtype=np.uint8)[None, :], chunks, 0)
    for t in range(width):
        maps = flat[maps.astype(np.int16) * columns + grid[:, t, None]]
    gap = 1
    while gap < chunks:
        maps[gap:] = np.take_along_axis(maps[gap:], maps[:-gap].astype(np.int64), 1)
        gap *= 2
    state = np.zeros(chunks, np.int16)
    state[1:] = maps[:-1, _START]
    marks = np.zeros((chunks, width), np.uint8)
    outputs = output.reshape(-1)
    for t in range(width):
        at = state * columns + grid[:, t]
        marks[:, t] = outputs[at]
        state = flat[at].astype(np.int16)
    marks = marks.reshape(-1)[:n]
    begins = marks & _HERE != 0
    begins[:-1] |= marks[1:] & _BEFORE != 0
    if state[-1] in (_QR, _QV, _QL):  # after the last character; the padding keeps the state
        begins[n - 1] = True
    return np.flatnonzero(begins)


class Vocabulary:
    """The tokens, the merges, and the transducer over bytes, whose transitions are compiled when first taken."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        splitter = spec["pre_tokenizer"] or {}
        if (
            spec["model"]["type"] != "BPE"
            or splitter.get("type") != "ByteLevel"
            or splitter.get("add_prefix_space")
            or not splitter.get("use_regex", True)
            or spec["normalizer"]
            or spec["model"].get("ignore_merges")
        ):
            raise ValueError("only byte-level BPE with the usual splitting pattern and without normalisation is read")
        added = spec["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens that take their surroundings are not read")
        # Added tokens are cut out of the text before it is split, the longest of those at one place.
        names = sorted((t["content"] for t in added), key=lambda s: (-len(s), s))
        self.added = re.compile("|".join(map(re.escape, names))) if names else None
        # Bytes as the file writes them: printable ones as themselves, the others from code point 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}

        def raw(token: str) -> bytes:
            return bytes(byte_of[c] for c in token)

        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)}
        special = {t["content"] for t in added}
        self.tokens = {raw(t) for t in spec["model"]["vocab"] if t not in special}
        self.prefixes = {t[:k] for t in self.tokens for k in range(len(t))}
        self.joins: dict[tuple[bytes, bytes], bool] = {}
        #: Tokens of a stretch: the composed transition from the start over all of its bytes.
        self.counts = Memo(self.count)
        self.clear()

    def clear(self) -> None:
        """Forget compiled transitions; they are compiled again when needed."""
        # A state: the longest end of the input that is a proper beginning of a token, and for each place in it the last token
        # up to there and the number of tokens up to there, relative to here.
        start = (b"", ((None, 0),))
        self.numbers, self.states, self.moves = {start: 0}, [start], {}

    def count(self, stretch: str) -> int:
        """Tokens of a stretch: the sum of the annotations along its bytes."""
        state = total = 0
        moves = self.moves
        for byte in stretch.encode("utf-8", "replace"):
            move = moves.get(state << 8 | byte)
            if move is None:
                move = moves[state << 8 | byte] = self._compile(state, byte)
            state = move[0]
            total += move[1]
        return total

    def _compile(self, number: int, byte: int) -> tuple[int, int]:
        """Target and annotation of a transition.

        The merges leave exactly one token at the end of each prefix: the one that stays apart from the last token of the
        prefix before it. It begins inside the kept end of the input, so the state holds all that decides it.
        """
        tail, history = self.states[number]
        grown = tail + bytes([byte])
        for length in range(len(grown), 0, -1):
            token = grown[-length:]
            last, before = history[len(history) - length]
            if token in self.tokens and self._stays(last, token):
                break
        else:
            raise ValueError(f"no token for byte {byte}")
        added = before + 1
        keep = next(k for k in range(len(grown), -1, -1) if grown[len(grown) - k :] in self.prefixes)
        moved = [*((t, n - added) for t, n in history), (token, 0)][len(history) - keep :]
        state = (grown[len(grown) - keep :], tuple(moved))
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
        return self.numbers[state], added

    def _stays(self, left: bytes | None, right: bytes) -> bool:
        known = self.joins.get((left, right))
        if known is None:
            expected = [right] if left is None else [left, right]
            known = self.joins[left, right] = self._merge((left or b"") + right) == expected
        return known

    def _merge(self, data: bytes) -> list[bytes]:
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, k = min((self.rank.get((parts[k], parts[k + 1]), 1 << 30), k) for k in range(len(parts) - 1))
            if best == 1 << 30:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def bound(self) -> None:
        """Keep what is compiled from growing with the input."""
        if len(self.joins) > 1 << 19:
            self.joins.clear()
        if len(self.moves) > 1 << 19:
            self.clear()

    def count_texts(self, texts: list[str]) -> list[int]:
        """Tokens of each whole text, special strings in it counted as what they stand for."""
        pieces, owner, extra = [], [], [0] * len(texts)
        for i, text in enumerate(texts):
            if self.added and self.added.search(text):
                parts = self.added.split(text)
                extra[i] = len(parts) - 1
                pieces += parts
                owner += [i] * len(parts)
            else:
                pieces.append(text)
                owner.append(i)
        joined = "".join(pieces)
        ends = np.cumsum([len(p) for p in pieces])
        first = (ends - [len(p) for p in pieces])[[len(p) > 0 for p in pieces]]
        kinds = classes()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
        at = stretches(kinds, first)
        if not len(at):
            return extra
        cuts = [*at.tolist(), len(joined)]
        found = [joined[a:b] for a, b in zip(cuts, cuts[1:])]
        numbers = np.fromiter(map(self.counts.__getitem__, found), np.int64, len(found))
        self.bound()
        of = np.array(owner)[np.searchsorted(ends, at, "right")]
        return (np.bincount(of, numbers, len(texts)).astype(np.int64) + np.array(extra)).tolist()


@lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    """A vocabulary, once per worker."""
    return Vocabulary(path)


def count_tokens(
    df: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), size: int = 1 << 20
) -> DataFrame:
    """The columns ``keep``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every whole text, as the vocabulary's own library counts.

    Null and empty texts have 0 of both. Texts are run in blocks of about ``size`` characters; a longer one is a block of its
    own. Repeated rows each return a row. ``path`` must be readable on the executors. Columns of ``keep`` with our names
    would clash: rename them first.
    """
    prepare(df.sparkSession)
    chosen = df.select(F.col(text).cast("string").alias("__text"), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            n_bytes = [n or 0 for n in pc.binary_length(batch.column(0)).to_pylist()]
            tokens: list[int] = []
            for start, stop in blocks(texts, len(texts), size):
                tokens += vocabulary.count_texts(texts[start:stop])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(n_bytes, pa.int64()), pa.array(tokens, pa.int64())],
                [*batch.schema.names[1:], "n_bytes", "n_tokens"],
            )

    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    return chosen.mapInArrow(run, T.StructType([*chosen.schema.fields[1:], *fields]))
