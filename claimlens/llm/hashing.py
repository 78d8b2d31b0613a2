"""64-bit hashes of words and of runs of units, over many texts at once with numpy.

Runs are hashed by prefix sums of unit * base**position modulo 2**64 and brought back to position 0 by the
base's inverse, so the hash of any run costs two look-ups. Texts are taken in chunks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of text that are hashed at once; a longer text is a chunk of its own.
CHUNK = 1 << 20

_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.uint64)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 12)
        for k, b in enumerate((_BASE, _INVERSE)):
            all_of = np.full(size, b, np.uint64)
            all_of[0] = 1
            _powers[k] = np.multiply.accumulate(all_of)
    return _powers[0][:n], _powers[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of h over all others."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


class Runs:
    """Hashes of runs of the units (64-bit numbers) in one array."""

    def __init__(self, units: np.ndarray) -> None:
        forth, self.back = powers(len(units) + 1)
        self.sums = np.zeros(len(units) + 1, np.uint64)
        np.cumsum(units * forth[:-1], out=self.sums[1:])

    def of_length(self, k: int) -> np.ndarray:
        """The hash of each run of k units, by its start."""
        if len(self.sums) <= k:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[k:] - self.sums[:-k]) * self.back[: len(self.sums) - k])

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def byte_units(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


@dataclass
class Words:
    """Words of the texts first .. last-1: one hash each, where they lie in `data`, and where each text's begin."""

    first: int
    last: int
    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray

    def text_of(self) -> np.ndarray:
        """Which text (counted from 0) each word is of."""
        return np.repeat(np.arange(self.last - self.first), np.diff(self.offsets))


def slices(batches, rows: int = 512) -> Iterator:
    """Arrow batches in pieces of so many rows, so that few texts are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def chunks(texts: list, limit: int = CHUNK) -> Iterator[tuple[int, int, list[bytes]]]:
    """Consecutive texts (str, bytes or None) as UTF-8, together up to about `limit` bytes."""
    own, first, size = [], 0, 0
    for i, t in enumerate(texts):
        raw = b"" if t is None else t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass")
        if own and size + len(raw) > limit:
            yield first, i, own
            own, first, size = [], i, 0
        own.append(raw)
        size += len(raw)
    if own:
        yield first, first + len(own), own


def words(texts: list, fold: bool = False, limit: int = CHUNK) -> Iterator[Words]:
    """Words of the texts, chunk by chunk. fold: A-Z count as a-z."""
    table = _FOLDED if fold else _BYTE
    for first, last, raws in chunks(texts, limit):
        data = b"\n".join(raws) + b"\n"
        b = np.frombuffer(data, np.uint8)
        edge = np.flatnonzero(np.diff(_BLANK[b], prepend=True))
        starts, ends = edge[::2], edge[1::2]
        begin = np.cumsum([0, *[len(r) + 1 for r in raws]])
        run = Runs(table[b])
        yield Words(first, last, data, starts, ends, run.between(starts, ends), np.searchsorted(starts, begin))


def shingles(w: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each run of `size` words within one text, in order; a shorter text with any word is one run."""
    run, own = Runs(w.hashes), w.text_of()
    h = run.of_length(size)
    whole = own[: len(h)] == own[size - 1 :]
    n = np.diff(w.offsets)
    short = np.flatnonzero((n > 0) & (n < size))
    few = run.between(w.offsets[short], w.offsets[short + 1])
    own, h = np.concatenate([own[: len(h)][whole], short]), np.concatenate([h[whole], few])
    order = np.argsort(own, kind="stable") if len(short) else slice(None)
    return own[order], h[order]
