"""Vectorised hashing of words and word n-grams over batches of texts, on executors."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow.compute as pc

_RNG = np.random.default_rng(20240229)
#: Odd multipliers, equal in every process.
_MIX = [np.uint64(int(x) * 2 + 1) for x in _RNG.integers(0, 2**63, 64)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SEPARATOR = np.zeros(256, dtype=bool)
_IS_SEPARATOR[[32, 9, 10, 11, 12, 13]] = True
#: Masks of the first n bytes of eight.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Bytes that must follow the last range.
PAD = 16


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def contents(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two 64-bit values and the length of each range of bytes, which tell ranges apart: the bytes
    themselves up to 16 of them, a 128-bit BLAKE2b digest of longer ones. `data` goes on for PAD bytes
    after the last range."""
    wide = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))  # the eight bytes from each place on
    n = ends - starts
    one = wide[starts] & _FIRST[np.minimum(n, 8)]
    two = wide[starts + 8] & _FIRST[np.clip(n - 8, 0, 8)]
    for k in np.flatnonzero(n > 16):
        one[k], two[k] = np.frombuffer(blake2b(data[starts[k] : ends[k]], digest_size=16).digest(), "<u8")
    return one, two, n


def hashed(one: np.ndarray, two: np.ndarray, n: np.ndarray) -> np.ndarray:
    """64-bit hashes of contents: nothing but chance makes two unlike ones collide."""
    return mix(mix(one + n.astype(np.uint64) * _MIX[63]) + two * _MIX[62])


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, the bounds of each text's words in them, the bytes of all
    texts with a space after each, and where each text starts in those."""
    data = np.frombuffer(b" ".join(texts) + b" " * (PAD + 1), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    if lower:
        data = _LOWER[data]
    whole, data = data, data[: at[-1]]
    gap = _IS_SEPARATOR[data]
    edge = np.flatnonzero(np.diff(gap.view(np.int8), prepend=1))
    starts, ends = edge[::2], edge[1::2]
    return hashed(*contents(whole, starts, ends)), np.searchsorted(starts, at), data, at


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams of a sequence of hashed words: one for each place where n fit."""
    if len(hashes) < n:
        return hashes[:0]
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        total += hashes[k : len(hashes) - n + 1 + k] * _MIX[k]
    return mix(total)


def shingle_set(hashes: np.ndarray, n: int) -> np.ndarray:
    """The distinct n-word shingles of one text; a shorter text with words is one shingle."""
    found = grams(hashes, min(n, len(hashes))) if len(hashes) else hashes
    return np.unique(found)


def batched(texts: Iterable[bytes], most: int = 400_000) -> Iterator[list[bytes]]:
    """Consecutive texts in lists of about `most` bytes: whole texts, one at least."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > most:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def small(batches: Iterable, column: str = "text", size: int = 4 << 20, rows: int = 2000) -> Iterator:
    """Slices of Arrow batches of about `size` bytes of a text column and at most `rows` rows, one row
    at least: what is made of a slice stays small, whatever Spark puts into a batch."""
    for batch in batches:
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch[column]), 0), np.int64).cumsum()
        start = 0
        while start < batch.num_rows:
            before = int(lengths[start - 1]) if start else 0
            end = min(max(start + 1, int(np.searchsorted(lengths, before + size, "right"))), start + rows, batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def as_bytes(column) -> Iterator[bytes]:
    """UTF-8 bytes of an Arrow string column, nulls as empty."""
    return (x.as_buffer().to_pybytes() if x.is_valid else b"" for x in column)
