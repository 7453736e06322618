"""Words, codes of words and packed arrays, shared by the operators.

Words are runs of bytes between ASCII white space, `bytes.split()`, which is
`[^\\x20\\x09-\\x0D]+` on the text. A word's code is 64 bits of its hash; what is
decided by codes alone compares at least two of them or whole sequences.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Words whose codes a worker remembers, and bytes of text it codes at a time.
REMEMBERED = 400_000
CHUNK_BYTES = 8 << 20


class WordCodes(dict):
    """word -> code; forgets all when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


def chunks(batch: pa.RecordBatch, column: str = "text",
           size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most `size` bytes of text, or one row."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    sizes = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        done = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, done + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def word_lists(texts: list[bytes | None], lower: bool = False) -> list[list[bytes]]:
    if lower:
        return [t.lower().split() if t else [] for t in texts]
    return [t.split() if t else [] for t in texts]


def coded(lists: list[list[bytes]], codes: dict) -> tuple[np.ndarray, np.ndarray]:
    """All codes one after another, and where each list starts, with the end."""
    starts = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=starts[1:])
    flat = np.fromiter(map(codes.__getitem__, chain.from_iterable(lists)),
                       np.uint64, int(starts[-1]))
    return flat, starts


def odd_constants(seed: int, n: int, dtype=np.uint64) -> np.ndarray:
    """n random odd numbers that follow from the seed."""
    bits = np.iinfo(dtype).bits
    drawn = np.random.default_rng(seed).integers(0, 2 ** bits, n, dtype=dtype, endpoint=False)
    return drawn | dtype(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def sequence_codes(flat: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Code of the n words from each place on; empty if there are fewer."""
    places = len(flat) - n + 1
    if places <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(places, np.uint64)
    for j, factor in enumerate(odd_constants(seed * 1009 + n, n)):
        total += flat[j:j + places] * factor
    return mixed(total)


def runs(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal values start in an ordered array, with the end."""
    if not len(ordered):
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1,
                           [len(ordered)]))
