"""Rising sequences and n-gram tries in little space: Elias-Fano levels that are searched where they lie."""

from __future__ import annotations

import mmap
import os
import struct

import numpy as np

#: Steps of a decade in the fixed-point logarithms: a probability is off by 0.23 % at most.
STEPS = 512
_POWERS = 10.0 ** ((1.0 - np.arange(1 << 16)) / STEPS)
_HEAD = struct.Struct("<qqqqq")
_BLOCK = 8  # words of 64 bits between two counts of the directory


def quantise(p: np.ndarray) -> np.ndarray:
    """Codes of probabilities in (0, 1]; 0 stands for none."""
    with np.errstate(divide="ignore"):
        code = np.rint(-np.log10(p) * STEPS) + 1
    return np.where(p > 0, np.minimum(code, 65535), 0).astype(np.uint16)


def dequantise(code: np.ndarray, none: float = 0.0) -> np.ndarray:
    return np.where(code > 0, _POWERS[code], none)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Numbers of ``width`` bits, one after the other; eight bytes of padding let a reader take whole words."""
    if not width:
        return np.zeros(8, np.uint8)
    bits = np.zeros((len(values), width), np.uint8)
    for i in range(width):
        bits[:, i] = (values >> np.uint64(i)) & np.uint64(1)
    return np.concatenate([np.packbits(bits.reshape(-1), bitorder="little"), np.zeros(8, np.uint8)])


def _unpack(data: np.ndarray, index: np.ndarray, width: int) -> np.ndarray:
    """The numbers at the places ``index``, at most 56 bits each."""
    if not width:
        return np.zeros(len(index), np.uint64)
    start = index * width
    words = data[(start >> 3)[:, None] + np.arange(8)].view("<u8").reshape(-1)
    return (words >> (start & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)


class EliasFano:
    """A sequence that never falls, of whole numbers below 2^56: low bits packed, high bits in unary.

    ``access`` gives the i-th number, ``successor`` the place of the first number that isn't below x; both take arrays. The data are
    views of the buffer that they were read from.
    """

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.width, self.low, self.high, self.ones = n, width, low, high, ones
        # Zeros before each block follow from the ones before it.
        self.zeros = np.arange(len(ones), dtype=np.int64) * (64 * _BLOCK) - ones

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        if top >= 1 << 56 or (values[1:] < values[:-1]).any():
            raise ValueError("numbers must not fall and must stay below 2^56")
        width = max(0, (top // max(n, 1)).bit_length() - 1)
        places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        # A closing one and zeros up to a whole block, so that each search meets its end.
        size = n + (top >> width) + 2
        words = -(-size // (64 * _BLOCK)) * _BLOCK
        bits = np.zeros(words * 64, np.uint8)
        bits[places] = 1
        high = np.packbits(bits, bitorder="little").view("<u8")
        counts = np.bitwise_count(high).reshape(-1, _BLOCK).sum(1, dtype=np.int64)
        ones = np.concatenate([[0], np.cumsum(counts)])[:-1].astype(np.int64)
        return cls(n, width, _pack(values & np.uint64((1 << width) - 1), width), high, ones)

    def to_bytes(self) -> bytes:
        low = self.low.tobytes() + b"\0" * (-len(self.low) % 8)
        return _HEAD.pack(self.n, self.width, len(low), len(self.high), len(self.ones)) + low + self.high.tobytes() + self.ones.tobytes()

    @classmethod
    def view(cls, data: np.ndarray, at: int = 0) -> tuple[EliasFano, int]:
        """The sequence that begins at a byte of a buffer, and the byte behind it. Nothing is copied."""
        n, width, low, high, ones = _HEAD.unpack(data[at : at + _HEAD.size].tobytes())
        at += _HEAD.size
        parts = []
        for size, kind in ((low, np.uint8), (8 * high, "<u8"), (8 * ones, "<i8")):
            parts.append(data[at : at + size].view(kind))
            at += size
        return cls(n, width, *parts), at

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Position of the k-th (from 0) one or zero of the high bits."""
        out = np.empty(len(k), np.int64)
        before = self.ones if ones else self.zeros
        for at in range(0, len(k), 1 << 14):
            part = k[at : at + (1 << 14)]
            block = np.searchsorted(before, part, "right") - 1
            words = self.high[block[:, None] * _BLOCK + np.arange(_BLOCK)]
            if not ones:
                words = ~words
            sums = np.cumsum(np.bitwise_count(words), 1, dtype=np.int64)
            rest = part - before[block]
            word = (sums <= rest[:, None]).sum(1)
            line = np.arange(len(part))
            rest = rest - np.where(word > 0, sums[line, word - 1], 0)
            x = words[line, word]
            place = np.zeros(len(part), np.int64)
            # Halve the word: the wanted bit is in the lower half if that has more ones than still to pass.
            for half in (32, 16, 8, 4, 2, 1):
                lower = np.bitwise_count(x & np.uint64((1 << half) - 1)).astype(np.int64)
                up = rest >= lower
                rest = rest - np.where(up, lower, 0)
                place += np.where(up, half, 0)
                x = np.where(up, x >> np.uint64(half), x)
            out[at : at + len(part)] = (block * _BLOCK + word) * 64 + place
        return out

    def access(self, i: np.ndarray) -> np.ndarray:
        high = (self._select(i, True) - i).astype(np.uint64)
        return ((high << np.uint64(self.width)) | _unpack(self.low, i, self.width)).astype(np.int64)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Place of the first number that is at least x; n where there is none."""
        out = np.full(len(x), self.n, np.int64)
        if not self.n:
            return out
        high = x >> self.width
        inside = np.flatnonzero(high < 64 * len(self.high) - self.n)  # as many zeros are there
        h = high[inside]
        first = np.where(h > 0, self._select(np.maximum(h - 1, 0), False) - h + 1, 0)
        last = self._select(h, False) - h
        low = (x[inside] & ((1 << self.width) - 1)).astype(np.uint64)
        while True:
            open_ = np.flatnonzero(first < last)
            if not len(open_):
                break
            middle = (first[open_] + last[open_]) // 2
            less = _unpack(self.low, middle, self.width) < low[open_]
            first[open_[less]] = middle[less] + 1
            last[open_[~less]] = middle[~less]
        out[inside] = first
        return out


class Trie:
    """Bigrams and trigrams under their first words, in three levels.

    Level 1 holds the first words, level 2 the second words of each, level 3 the third words of each pair. Pointers
    from a level to the next rise, and so do the numbers of a level: those of one parent follow on the last one of the parent
    before, so a number is stored relative to its context and found by a successor search from there. Probabilities and
    weights are 16-bit logarithms: the discounted probability of a bigram and of a trigram, and the weight that a word and a pair
    leave to shorter contexts.
    """

    FIELDS = ("first", "to_second", "second", "to_third", "third")
    CODES = ("weight_1", "p_2", "weight_2", "p_3")

    def __init__(self, sequences: dict[str, EliasFano], codes: dict[str, np.ndarray]):
        self.__dict__.update(sequences | codes)

    @classmethod
    def build(cls, second: np.ndarray, third: np.ndarray, p: dict[str, np.ndarray]) -> bytes:
        """From bigrams (n, 2) and trigrams (n, 3) of ids, both in rising order and without repeats, every trigram's first two words among the bigrams."""
        first, begins = np.unique(second[:, 0], return_index=True)
        to_second = np.append(begins, len(second))
        counts = np.bincount(cls.pairs(second, third), minlength=len(second))
        to_third = np.concatenate([[0], np.cumsum(counts)])
        sequences = [first, to_second, _relative(second[:, 1], to_second), to_third, _relative(third[:, 2], to_third)]
        parts = [EliasFano.build(s).to_bytes() for s in sequences]
        for name in cls.CODES:
            data = quantise(p[name]).tobytes()
            parts.append(struct.pack("<q", len(data)) + data + b"\0" * (-len(data) % 8))
        return b"".join(parts)

    @staticmethod
    def pairs(second: np.ndarray, third: np.ndarray) -> np.ndarray:
        """Place of each trigram's first two words among the bigrams."""
        values = [np.unique(second[:, i]) for i in (0, 1)]
        code = [np.searchsorted(values[0], x[:, 0]) * len(values[1]) + np.searchsorted(values[1], x[:, 1]) for x in (second, third)]
        return np.searchsorted(*code)

    @classmethod
    def view(cls, data) -> Trie:
        """A trie on a buffer: the bytes that a task was handed, or a mapped file."""
        buffer = np.frombuffer(data, np.uint8)
        at, sequences, codes = 0, {}, {}
        for name in cls.FIELDS:
            sequences[name], at = EliasFano.view(buffer, at)
        for name in cls.CODES:
            size = struct.unpack("<q", buffer[at : at + 8].tobytes())[0]
            codes[name] = buffer[at + 8 : at + 8 + size].view("<u2")
            at += 8 + size + -size % 8
        return cls(sequences, codes)

    @classmethod
    def mapped(cls, path: str | os.PathLike) -> Trie:
        with open(path, "rb") as file:
            return cls.view(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))

    def look_up(self, words: np.ndarray) -> dict[str, np.ndarray]:
        """Codes for rows (u, v, w) of ids, negative where there is no such word: of the weight of u, of v after u, of the weight of
        (u, v), of w after (u, v); 0 where the trie has none. Rows that follow each other with one prefix share its search."""
        out = {name: np.zeros(len(words), np.uint16) for name in self.CODES}
        if not self.first.n or not len(words):
            return out
        new_u = np.diff(words[:, 0], prepend=words[0, 0] - 1) != 0
        new_v = new_u | (np.diff(words[:, 1], prepend=words[0, 1] - 1) != 0)
        of_u, of_v = np.cumsum(new_u) - 1, np.cumsum(new_v) - 1
        us, vs = np.flatnonzero(new_u), np.flatnonzero(new_v)
        # Where each prefix lies in its level; -1 where it isn't in the trie.
        place_u, place_v = np.full(len(us), -1), np.full(len(vs), -1)
        known = np.flatnonzero(words[us, 0] >= 0)
        found, place = _same(self.first, words[us[known], 0], known, self.first.successor(words[us[known], 0]))
        place_u[found] = place
        out["weight_1"][:] = np.where(place_u >= 0, self.weight_1[np.maximum(place_u, 0)], 0)[of_u]
        known = np.flatnonzero(place_u[of_u[vs]] >= 0)
        found, place = self._below(self.to_second, self.second, words[vs, 1], known, place_u[of_u[vs[known]]])
        place_v[found] = place
        for name in ("p_2", "weight_2"):
            out[name][:] = np.where(place_v >= 0, getattr(self, name)[np.maximum(place_v, 0)], 0)[of_v]
        known = np.flatnonzero(place_v[of_v] >= 0)
        found, place = self._below(self.to_third, self.third, words[:, 2], known, place_v[of_v[known]])
        out["p_3"][found] = self.p_3[place]
        return out

    @staticmethod
    def _below(pointers: EliasFano, level: EliasFano, words: np.ndarray, here: np.ndarray, parent: np.ndarray):
        keep = words[here] >= 0
        here, parent = here[keep], parent[keep]
        if not len(here):
            return here, parent
        # Pointers of a parent that many rows share are read once.
        parents, of = np.unique(parent, return_inverse=True)
        begin, end = pointers.access(parents)[of], pointers.access(parents + 1)[of]
        keep = begin < end
        here, begin, end = here[keep], begin[keep], end[keep]
        before, of = np.unique(begin, return_inverse=True)
        base = np.where(before > 0, level.access(np.maximum(before - 1, 0)), 0)[of] if len(before) else begin
        wanted = base + words[here] + 1
        place = level.successor(wanted)
        keep = place < end
        return _same(level, wanted[keep], here[keep], place[keep])


def _relative(values: np.ndarray, pointers: np.ndarray) -> np.ndarray:
    """Numbers counted on from the last one of the context before; rising throughout."""
    begin, end = pointers[:-1], pointers[1:]
    filled = begin < end
    lasts = np.zeros(len(begin), np.int64)
    lasts[filled] = values[end[filled] - 1].astype(np.int64) + 1
    base = np.concatenate([[0], np.cumsum(lasts)[:-1]]) if len(lasts) else lasts
    return values.astype(np.int64) + 1 + np.repeat(base, end - begin)


def _same(level: EliasFano, wanted: np.ndarray, here: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the places that hold just the wanted number."""
    inside = np.flatnonzero(place < level.n)
    inside = inside[level.access(place[inside]) == wanted[inside]]
    return here[inside], place[inside]
