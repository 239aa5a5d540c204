"""Sets of word shingles as sorted 64-bit hashes, and their compressed HyperMinHash registers."""

from __future__ import annotations

import math

import numpy as np
import xxhash

from burstline.llm.common import blank_words

SHINGLE = 5
BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS  # registers of a sketch
MANTISSA = 10  # bits kept behind the leading one
MISSED = 4.5e-7  # of the pairs at the threshold: those that may share no band
MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """A task's table of word hashes, started anew at a fixed size."""

    LIMIT = 60_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * MIX
    return h ^ (h >> np.uint64(29))


def shingle_set(text: bytes | None, known: WordHashes, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``n`` words; of all words together if they are fewer; empty without words."""
    words = blank_words(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    ids = np.array([known[w] for w in words], dtype=np.uint64)
    size = min(n, len(ids))
    total = np.full(len(ids) - size + 1, np.uint64(size))
    for k in range(size):
        total = _mixed(total + ids[k : len(ids) - size + 1 + k])
    return np.unique(total)


def _packed(value: np.ndarray) -> np.ndarray:
    """One more than the leading zeros, and the bits behind the leading one: never 0."""
    length = np.frexp((value >> np.uint64(11)).astype(np.float64))[1].astype(np.uint64)  # of 53 bits, so exact
    behind = value << (np.uint64(53) - length) << np.uint64(1)
    return ((np.uint64(54) - length) << np.uint64(MANTISSA) | behind >> np.uint64(64 - MANTISSA)).astype(np.uint16)


# For an empty register, the registers to copy from: the first of these that is not empty.
DETOURS = np.random.default_rng(7).integers(0, BUCKETS, size=(BUCKETS, 4 * BUCKETS))


def registers(hashes: np.ndarray) -> np.ndarray:
    """Per bucket of the hashes' first bits: the leading zeros of the smallest rest, and the bits behind its leading one.

    Buckets without a hash copy another by a fixed list of detours, the same for every document.
    """
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    out = np.zeros(BUCKETS, dtype=np.uint16)
    filled = np.zeros(BUCKETS, dtype=bool)
    out[bucket[first]] = _packed(hashes[first] << np.uint64(BUCKET_BITS))
    filled[bucket[first]] = True
    empty = np.flatnonzero(~filled)
    if len(empty):
        tries = filled[DETOURS[empty]]
        pick = tries.argmax(axis=1)
        source = DETOURS[empty, pick]
        # A detour list that meets no full register at all: the first full one.
        source[~tries[np.arange(len(empty)), pick]] = np.flatnonzero(filled)[0]
        out[empty] = out[source]
    return out


def bands_for(percent: int) -> tuple[int, int]:
    """Bands and registers of each: the longest bands of which so few are needed that all fit into a sketch.

    Pairs as similar as ``percent`` share no band in MISSED of the cases at most: 25 bands of five for 85, 28 of four for 80.
    Far below 15 no choice is good enough; then every register is a band.
    """
    for rows in range(BUCKETS, 0, -1):
        apart = 1 - (percent / 100) ** rows
        bands = math.ceil(math.log(MISSED) / math.log(apart)) if 0 < apart < 1 else 1 if apart <= 0 else BUCKETS + 1
        if bands * rows <= BUCKETS:
            return bands, rows
    return BUCKETS, 1


def band_keys(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each sketch (a row of registers)."""
    used = sketches[:, : bands * rows].astype(np.uint64).reshape(len(sketches), bands, rows)
    total = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sketches), bands)).copy()
    for k in range(rows):
        total = _mixed(total + used[:, :, k])
    return total.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from equal registers, less the equal ones that chance makes.

    Two registers of different minima agree when leading zeros and mantissa do: by the published bound
    about 0.17 * 4ab/(a+b)^2 / 2^bits of the registers.
    """
    equal = (a == b).mean(axis=-1)
    total = np.maximum(sizes_a + sizes_b, 1).astype(np.float64)
    chance = 0.169919 * 4 * sizes_a * sizes_b / total**2 / (1 << MANTISSA)
    return np.clip((equal - chance) / (1 - chance), 0, 1)


FINE_BITS = 9
FINE = 1 << FINE_BITS


def fine_registers(hashes: np.ndarray) -> np.ndarray:
    """512 registers of the same kind without detours; 0 where no hash fell. Equal registers stand for equal minima."""
    bucket = (hashes >> np.uint64(64 - FINE_BITS)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    out = np.zeros(FINE, dtype=np.uint16)
    out[bucket[first]] = _packed(hashes[first] << np.uint64(FINE_BITS))
    return out


def fine_estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of every row of ``a`` with every row of ``b``: equal among the registers that either has, less chance."""
    out = np.zeros((len(a), len(b)))
    for low in range(0, len(a), 32):
        part = a[low : low + 32, None, :]
        full = part > 0
        equal = ((part == b[None]) & full).sum(axis=-1)
        either = (full | (b[None] > 0)).sum(axis=-1)
        out[low : low + 32] = equal / np.maximum(either, 1)
    chance = 0.169919 / (1 << MANTISSA)
    return np.clip((out - chance) / (1 - chance), 0, 1)
