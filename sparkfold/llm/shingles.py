"""Word shingles as sorted sets of 64-bit hashes, in numpy inside tasks."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Entries of the table of word hashes that a worker keeps.
MEMO = 200_000


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _Words()
_BASE = np.uint64(0x9E3779B97F4A7C15)


def forget() -> None:
    """Drop the table of word hashes. A function of the module, so that it is the worker's own table."""
    _WORDS.clear()


def forgetting(run):
    """An Arrow function after whose task the worker remembers no words.

    Workers are used again, also by what hashes no words: they would hold the table for good.
    """

    @functools.wraps(run)
    def then_forget(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            forget()

    return then_forget


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads their bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of `width` words, separated by ASCII white space.

    A text with fewer words has one shingle of all of them; without words there is none.
    """
    words = (text or "").encode().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    codes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    runs = max(1, len(codes) - width + 1)
    hashes = np.zeros(runs, dtype=np.uint64)
    for k in range(min(width, len(codes))):
        hashes = hashes * _BASE + codes[k : k + runs]
    return np.unique(mix(hashes + np.uint64(min(width, len(codes)))))


def stars(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least index of the component of each of n items linked by the pairs (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows of equal keys, from batches sorted by them; a run must fit in memory."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        change[0] = True
        for c in columns:
            codes = c.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            change[1:] |= codes[1:] != codes[:-1]
        starts = [*np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            key = tuple(c[a].as_py() for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
