"""Hashes of word shingles, for whole batches of texts at a time."""

from __future__ import annotations

import numpy as np

from voicelane.llm.common import WordHashes, folded_words

SHINGLE = 5
#: Odd multipliers, one per place in a shingle.
_PLACES = np.array(
    [0x9E3779B97F4A7C15 * (2 * k + 1) % 2**64 | 1 for k in range(SHINGLE)], np.uint64
)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None, hashes: WordHashes) -> np.ndarray:
    words = folded_words(text)
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """A hash per run of five words; a shorter text, if it has words, is one shingle."""
    n = len(words) - SHINGLE + 1
    if n < 1:
        if not len(words):
            return words
        return mixed((words * _PLACES[: len(words)]).sum(keepdims=True, dtype=np.uint64))
    total = words[:n] * _PLACES[0]
    for k in range(1, SHINGLE):
        total += words[k : n + k] * _PLACES[k]
    return mixed(total)
