"""Elias-Fano coded levels of a bigram trie in flat buffers.

A monotone sequence is split into low bits, packed side by side, and high bits, kept
as a bit vector with one 1 per value and one 0 per high part. Buffers are mapped as
they are (``np.frombuffer``); nothing is unpacked to search them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_ZEROS = np.array([8 - b.bit_count() for b in range(256)], np.uint8)
#: Place of the k-th zero bit of a byte (lowest bit first); 8 if there are fewer.
_ZERO_AT = np.full((256, 8), 8, np.uint8)
for _b in range(256):
    _at = [k for k in range(8) if not _b >> k & 1]
    _ZERO_AT[_b, : len(_at)] = _at


@dataclass
class EliasFano:
    n: int
    low_bits: int
    low: bytes
    high: bytes

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        """Code ascending values below ``universe``."""
        n = len(values)
        bits = max(0, int(universe // max(n, 1)).bit_length() - 1)
        values = values.astype(np.int64)
        low = b""
        if bits and n:
            each = np.empty((n, bits), np.uint8)
            for k in range(bits):
                each[:, k] = (values >> k) & 1
            low = np.packbits(each.ravel(), bitorder="little").tobytes()
        marks = np.zeros(n + (universe >> bits) + 1, np.uint8)
        marks[(values >> bits) + np.arange(n)] = 1
        return cls(n, bits, low + bytes(8), np.packbits(marks, bitorder="little").tobytes())

    def open(self) -> EliasFano:
        """Set up the directory of zeros (one count per byte of the high bits)."""
        self._low = np.frombuffer(self.low, np.uint8)
        self._high = np.frombuffer(self.high, np.uint8)
        zeros = np.cumsum(_ZEROS[self._high], dtype=np.int64)
        self._before = np.concatenate(([0], zeros))
        return self

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Place of the k-th zero of the high bits."""
        byte = np.searchsorted(self._before, k, "right") - 1
        return byte * 8 + _ZERO_AT[self._high[byte], k - self._before[byte]]

    def _low_of(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros_like(i)
        at = i * self.low_bits
        byte, shift = at >> 3, at & 7
        value = np.zeros_like(i)
        for k in range((self.low_bits + 14) // 8):
            value |= self._low[byte + k].astype(np.int64) << (8 * k)
        return (value >> shift) & ((1 << self.low_bits) - 1)

    def bucket(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the values with given high parts: from, to."""
        start = np.where(high > 0, self._zero(np.maximum(high - 1, 0)) - (high - 1), 0)
        return start, self._zero(high) - high

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first value not below each x, and whether it equals x."""
        x = np.asarray(x, np.int64)
        lo, stop = self.bucket(x >> self.low_bits)
        hi, wanted = stop.copy(), x & ((1 << self.low_bits) - 1)
        while (open_ := lo < hi).any():
            middle = (lo + hi) >> 1
            less = self._low_of(np.minimum(middle, max(self.n - 1, 0))) < wanted
            lo, hi = np.where(open_ & less, middle + 1, lo), np.where(open_ & ~less, middle, hi)
        inside = lo < stop
        if not self.n:
            return lo, inside
        return lo, inside & (self._low_of(np.minimum(lo, self.n - 1)) == wanted)

    def at(self, i: np.ndarray) -> np.ndarray:
        """Values at places, by search over the high parts."""
        i = np.asarray(i, np.int64)
        ones = np.cumsum(8 - _ZEROS[self._high].astype(np.int64))
        byte = np.searchsorted(ones, i, "right")
        rest = i - np.where(byte > 0, ones[np.maximum(byte - 1, 0)], 0)
        place = byte * 8 + _ZERO_AT[255 - self._high[byte], rest]
        return ((place - i) << self.low_bits) | self._low_of(i)


@dataclass
class BigramTrie:
    """Contexts, pointers to their successors, successors, and a code per bigram.

    Successors are stored relative to their context: the sequence adds the rank of the
    context, so a query finds the rank, then searches among that context's successors.
    """

    contexts: EliasFano
    pointers: EliasFano
    successors: EliasFano
    codes: bytes
    book: bytes
    vocabulary: int

    @classmethod
    def of(cls, context: np.ndarray, word: np.ndarray, value: np.ndarray, vocabulary: int, levels: int = 256) -> BigramTrie:
        """Build from bigrams sorted by (context, word) with a value in (0, 1] each."""
        own, start = np.unique(context, return_index=True)
        rank = np.searchsorted(own, context)
        # The code book holds the means of equally filled ranges of the logarithm.
        logs = np.log(np.maximum(value, 1e-300))
        edges = np.unique(np.quantile(logs, np.linspace(0, 1, levels + 1)[1:-1])) if len(logs) else np.empty(0)
        codes = np.searchsorted(edges, logs, "right")
        count = np.maximum(np.bincount(codes, minlength=len(edges) + 1), 1)
        book = np.exp(np.bincount(codes, logs, len(edges) + 1) / count)
        return cls(
            EliasFano.of(own, vocabulary),
            EliasFano.of(np.append(start, len(context)), len(context) + 1),
            EliasFano.of(rank.astype(np.int64) * vocabulary + word, max(len(own), 1) * vocabulary),
            codes.astype(np.uint8).tobytes(), book.astype(np.float64).tobytes(), vocabulary,
        )

    def open(self) -> BigramTrie:
        for level in (self.contexts, self.pointers, self.successors):
            level.open()
        self._codes = np.frombuffer(self.codes, np.uint8)
        self._book = np.frombuffer(self.book, np.float64)
        return self

    def followers(self, context: np.ndarray) -> np.ndarray:
        """Distinct successors of each context."""
        rank, known = self.contexts.successor(context)
        rank = np.where(known, rank, 0)
        return np.where(known, self.pointers.at(rank + 1) - self.pointers.at(rank), 0)

    def value(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The stored value of each bigram; 0 where there is none."""
        rank, known = self.contexts.successor(context)
        place, found = self.successors.successor(np.where(known, rank, 0) * self.vocabulary + word)
        found &= known
        if not len(self._codes):
            return np.zeros(len(place))
        return np.where(found, self._book[self._codes[np.where(found, place, 0)]], 0.0)
