"""A minimal perfect hash over 128-bit keys (two 64-bit halves), built and probed with numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

GAMMA = 2.0
"""Bits of a level per key that is left; more bits place more keys in the first level."""


def _mix(key: np.ndarray, half: np.ndarray, seed: int) -> np.ndarray:
    x = key ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = x ^ half
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@dataclass
class PerfectHash:
    """Levels of bit arrays: a key lives in the first level where no other key met its bit.

    `words` joins the levels, `sizes` counts the words of each. Levels double in relative size, so
    the remaining keys shrink in every one and distinct pairs always end.
    """

    words: np.ndarray
    sizes: np.ndarray

    @classmethod
    def build(cls, key: np.ndarray, half: np.ndarray) -> PerfectHash:
        """Distinct pairs of int64 halves; slots 0..len-1 are handed out without gaps."""
        key, half = key.view(np.uint64), half.view(np.uint64)
        levels: list[np.ndarray] = []
        while len(key):
            n_words = max(1, int(np.ceil(GAMMA * len(key) * (1 + len(levels) / 8) / 64)))
            at = (_mix(key, half, len(levels)) % np.uint64(64 * n_words)).astype(np.int64)
            alone = np.bincount(at, minlength=64 * n_words) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            key, half = key[~alone[at]], half[~alone[at]]
        words = np.concatenate(levels) if levels else np.zeros(0, "<u8")
        return cls(words, np.array([len(x) for x in levels], np.int64))

    def slots(self, key: np.ndarray, half: np.ndarray) -> np.ndarray:
        """The slot of every pair; -1, or the slot of another pair, for one that was not built in."""
        key, half = key.view(np.uint64), half.view(np.uint64)
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        out, open_, start = np.full(len(key), -1, np.int64), np.arange(len(key)), 0
        for seed, size in enumerate(self.sizes.tolist()):
            at = _mix(key[open_], half[open_], seed) % np.uint64(64 * size)
            word, bit = start + (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            lower = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_[hit]] = (before[word] + np.bitwise_count(lower))[hit]
            open_, start = open_[~hit], start + size
        return out
