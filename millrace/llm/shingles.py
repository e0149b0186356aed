"""Word shingles of texts as 64-bit hashes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Odd multipliers of the rolling hashes and of the finishing steps.
BASE = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
PART = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """Each value with its bits spread over all 64."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def inverse(base: np.uint64 = BASE) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def word_bytes() -> np.ndarray:
    """Bytes that belong to words: ASCII letters and digits, and all bytes of other characters."""
    out = np.zeros(256, bool)
    out[128:] = True
    out[[b for b in range(128) if chr(b).isalnum()]] = True
    return out


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a byte array."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = word_bytes()[data]
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    ends = np.flatnonzero(inside[:-1] & ~inside[1:])
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=sums[1:])
    back = powers(len(data) + 1, inverse())
    return starts, mixed((sums[ends] - sums[starts]) * back[starts])


def shingle_sets(texts: list[str], words: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each text: runs of ``words`` words, lower-cased; of a shorter text all its words; of none, none.

    Texts are coded about PART bytes at a time, never a whole batch.
    """
    part: list[bytes] = []
    size = 0
    for text in texts:
        part.append(text.lower().encode("utf-8", "surrogatepass") + b"\n")
        size += len(part[-1])
        if size >= PART:
            yield from _part_sets(part, words)
            part, size = [], 0
    if part:
        yield from _part_sets(part, words)


def _part_sets(coded: list[bytes], words: int) -> Iterator[np.ndarray]:
    offsets = np.concatenate(([0], np.cumsum([len(c) for c in coded]))).astype(np.int64)
    starts, hashes = word_hashes(np.frombuffer(b"".join(coded), np.uint8))
    bounds = np.searchsorted(starts, offsets)
    n = max(0, len(hashes) - words + 1)
    runs = np.zeros(n, np.uint64)
    for k in range(words):
        runs = runs * STEP + hashes[k:n + k]
    runs = mixed(runs)
    for lo, hi in zip(bounds, bounds[1:]):
        if hi - lo >= words:
            yield np.unique(runs[lo:hi - words + 1])
        else:
            one = np.uint64(0)
            with np.errstate(over="ignore"):
                for h in hashes[lo:hi]:
                    one = one * STEP + h
            yield mixed(np.array([one + np.uint64(hi - lo)])) if hi > lo else np.empty(0, np.uint64)
