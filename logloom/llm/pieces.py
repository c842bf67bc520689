"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives one pass of dynamic programming."""

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.common import Memo, prepare

SPACE = "▁"
_NORMAL, _BYTE, _UNIGRAM, _BPE = 1, 6, 1, 2
_SLICE = 1 << 20
#: What a worker that has done its task may keep for the next: so many remembered chunks and neighbours (about 15 MB).
_KEPT = 1 << 16


class Pieces:
    """A model's pieces and the automaton over them. Models must leave texts as they are (identity normalisation)."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models with identity normalisation are read")
        if model.trainer_spec.model_type not in (_UNIGRAM, _BPE) or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only unigram and BPE models with white space as prefix are read")
        self.bpe = model.trainer_spec.model_type == _BPE
        self.prefix = SPACE if rules.add_dummy_prefix else ""
        self.pieces = [p.piece for p in model.pieces]
        self.scores = [p.score for p in model.pieces]
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == 2)
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.worst = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10.0
        # Where no piece crosses, texts can be cut without loss: before a space mark, around characters of no piece, and
        # between a run of letters or digits and a mark that follows none in any piece.
        crossing = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        pairs = {(a.isalnum(), b) for p in self.ids for a, b in zip(p, p[1:])}
        apart = "".join(c for c in "\n\t" if not any(c in p for p in self.ids))
        marks = "".join(re.escape(c) for c in ".,;:!?)|*%&#$" if (True, c) not in pairs)
        word = rf"{SPACE}*[^\W_]+(?=[{marks}])|" if marks else ""
        pattern = f"{word}{SPACE}*[^{SPACE}{apart}]+|{SPACE}+" + (f"|[{apart}]+" if apart else "")
        self.chunks = re.compile(r"(?s).+" if crossing else pattern).findall
        self.crossing = crossing
        self.memo = Memo(self._ids)
        self.joins: dict[int, bool] = {}
        self.plain = [self._bytes(i, p) for i, p in enumerate(model.pieces)]

    @staticmethod
    def _bytes(i: int, piece) -> bytes:
        if piece.type == _BYTE:
            return bytes([int(piece.piece[3:5], 16)])
        if piece.type == 2:
            return " ⁇ ".encode()
        return piece.piece.replace(SPACE, " ").encode() if piece.type == _NORMAL else b""

    def _ids(self, chunk: str) -> bytes:
        return array("i", self.best_path(chunk)).tobytes()

    def rest(self) -> None:
        """Forget what was remembered, if it is much: the worker lives on in steps that don't need it."""
        if len(self.memo) + len(self.memo.last) + len(self.joins) > _KEPT:
            self.memo = Memo(self._ids)
            self.joins.clear()

    def best_path(self, chunk: str) -> list[int]:
        """Ids of the best segmentation of a chunk, in one pass over its characters.

        At each position the automaton's output links give every piece that ends there. Of a unigram model the piece with
        the best summed score wins. A BPE model's scores rank its merges, so there the piece wins that the merges would
        leave: the one that, after the best path up to its start, stays apart from that path's last piece.
        There is exactly one (a path is what the merges give when each two neighbours are), so this, too, is one pass.
        Characters of no piece are unknown.
        """
        n = len(chunk)
        last = [-2] * (n + 1)  # id of the last piece of the best path to a position; -1 unknown, -2 none yet
        back = [0] * (n + 1)
        if self.bpe:
            gaps = [i for i, c in enumerate(chunk) if c not in self.ids]
            for i in gaps:
                last[i + 1], back[i + 1] = -1, i
            stays, known = self.stays, self.joins.get
            for end, (length, piece) in self.automaton.iter(chunk):
                if last[end + 1] == -2:
                    start = end + 1 - length
                    left = last[start] if start else -1
                    if left != -2:
                        apart = known(left << 20 | piece)
                        if stays(left, piece) if apart is None else apart:
                            last[end + 1], back[end + 1] = piece, start
        else:
            total = [0.0] + [-1e300] * n
            ends = self.automaton.iter(chunk)
            found = next(ends, None)
            for end in range(n):
                covered = False
                while found and found[0] == end:
                    length, piece = found[1]
                    start = end + 1 - length
                    covered |= length == 1
                    if total[start] + self.scores[piece] > total[end + 1]:
                        total[end + 1] = total[start] + self.scores[piece]
                        last[end + 1], back[end + 1] = piece, start
                    found = next(ends, None)
                if not covered and total[end] + self.worst > total[end + 1]:
                    total[end + 1] = total[end] + self.worst
                    last[end + 1], back[end + 1] = -1, end
        out, at = [], n
        while at:
            piece, start = last[at], back[at]
            out += [piece] if piece >= 0 else self._spell(chunk[start:at])[::-1]
            at = start
        return out[::-1]

    def _spell(self, character: str) -> list[int]:
        data = character.encode("utf-8", "surrogatepass")
        return [self.bytes[b] for b in data] if self.bytes else [self.unknown]

    def stays(self, left: int, right: int) -> bool:
        """Whether the merges leave two pieces apart when their texts stand side by side; -1 on the left is no piece."""
        if len(self.joins) >= 1 << 19:
            self.joins.clear()
        before, after = self.pieces[left] if left >= 0 else "", self.pieces[right]
        apart = self.joins[left << 20 | right] = self._merge(before + after) == ([before, after] if before else [after])
        return apart

    def _merge(self, text: str) -> list[str]:
        """Merge neighbours while their concatenation is a piece, the best score first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            options = [(-self.scores[i], k) for k in range(len(parts) - 1) if (i := self.ids.get(parts[k] + parts[k + 1])) is not None]
            if not options:
                break
            k = min(options)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def encode(self, text: str | None) -> bytes:
        """Ids as bytes of int32; none for null and empty texts. Long texts are cut before a word, which changes nothing."""
        if not text:
            return b""
        marked = (self.prefix + text).replace(" ", SPACE)
        if len(marked) <= _SLICE or self.crossing:
            return b"".join(map(self.memo.__getitem__, self.chunks(marked)))
        out, start = [], 0
        while start < len(marked):
            stop = start + _SLICE
            while stop < len(marked) and not (marked[stop] == SPACE and marked[stop - 1] != SPACE):
                stop += 1
            out.append(b"".join(map(self.memo.__getitem__, self.chunks(marked[start:stop]))))
            start = stop
        return b"".join(out)

    def round_trip(self, text: str | None, ids: bytes) -> bool:
        """Whether the ids, decoded, are the text. They are not where it holds a space mark of the model's own (U+2581)."""
        return self.decode(np.frombuffer(ids, np.int32).tolist()) == (text or "")

    def decode(self, ids: list[int]) -> str:
        data = b"".join(map(self.plain.__getitem__, ids))
        return data[1:].decode("utf-8", "replace") if self.prefix and data[:1] == b" " else data.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    """A model, once per worker."""
    return Pieces(path)


def encode(df: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, and ``ids`` (array of int), ``n_ids`` and ``round_trip`` of every whole text.

    ``round_trip`` says whether the ids, decoded again, give the very text (a null text counts as empty); a text that holds
    the model's space mark (U+2581) reads otherwise, so it is false there.

    Null and empty texts have no ids. Repeated rows each return a row; an empty table gives an empty one. ``path`` must be
    readable on the executors. Columns of ``keep`` with our names would clash: rename them first.
    """
    prepare(df.sparkSession)
    chosen = df.select(F.col(text).cast("string").alias("__text"), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            found = [pieces.encode(t) for t in texts]
            same = [pieces.round_trip(t, x) for t, x in zip(texts, found)]
            offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), np.int32)))
            counts = pa.array(np.diff(offsets).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], ids, counts, pa.array(same)], [*batch.schema.names[1:], "ids", "n_ids", "round_trip"]
            )
        pieces.rest()

    fields = [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_ids", T.LongType()),
        T.StructField("round_trip", T.BooleanType()),
    ]
    return chosen.mapInArrow(run, T.StructType([*chosen.schema.fields[1:], *fields]))


def decode(df: DataFrame, path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``decoded``, the text that the ids stand for.

    It is the encoded text, but for a space mark of the model's own (U+2581) in it, which reads as a space. Null ids and no
    ids give the empty text.
    """
    prepare(df.sparkSession)
    chosen = df.select(F.col(ids).alias("__ids"), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for batch in batches:
            lists = batch.column(0)
            values = lists.flatten().to_pylist()
            lengths = [n or 0 for n in lists.value_lengths().to_pylist()]
            ends = np.cumsum(lengths).tolist()
            texts = [pieces.decode(values[e - n : e]) for n, e in zip(lengths, ends)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], [*batch.schema.names[1:], "decoded"])

    return chosen.mapInArrow(run, T.StructType([*chosen.schema.fields[1:], T.StructField("decoded", T.StringType())]))
