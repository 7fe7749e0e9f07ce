"""Words of many texts at once, on UTF-8 bytes.

Separators are ASCII in both word definitions used here, so bytes and code
points split texts at the same places.  Words, and runs of words, are known by
64-bit hashes: short words by a polynomial, which runs of bytes make cheap; long
ones, for which unequal words of one value can be built, by xxhash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Bytes of text handled in one go; a longer text is handled alone.
SLICE_BYTES = 1 << 19
# Bytes of a word that is hashed as a polynomial.
SHORT_WORD = 64

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _set(*ranges: tuple[int, int]) -> np.ndarray:
    member = np.zeros(256, dtype=bool)
    for low, high in ranges:
        member[low : high + 1] = True
    return member


# [^\x20\x09-\x0D]
NOT_SPACE = ~_set((0x20, 0x20), (0x09, 0x0D))
# [^\x00-\x2F\x3A-\x60\x7B-\x7F], after A-Z became a-z
ALPHANUMERIC = ~_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def mix(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    value = (value ^ (value >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return value ^ (value >> np.uint64(32))


def _running_product(factor: int, n: int) -> np.ndarray:
    steps = np.full(n, factor, dtype=np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


@lru_cache(maxsize=2)
def _usual_powers() -> tuple[np.ndarray, np.ndarray]:
    n = SLICE_BYTES + 1
    return _running_product(_BASE, n), _running_product(_BASE_INVERSE, n)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n <= SLICE_BYTES + 1:
        return _usual_powers()
    return _running_product(_BASE, n), _running_product(_BASE_INVERSE, n)


@dataclass
class Words:
    """Words of consecutive texts: ``first[d]:first[d + 1]`` are text d's."""

    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(data: np.ndarray, bounds: np.ndarray, member: np.ndarray) -> Words:
    """``data``: bytes of all texts, ``bounds``: where each begins, and the end."""
    data = _LOWER[data]
    inside = member[data]
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:], after[:-1] = False, inside[1:]
    after[edges - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * power[: len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
    for word in np.flatnonzero(ends - starts > SHORT_WORD):
        hashes[word] = xxhash.xxh3_64_intdigest(data[starts[word] : ends[word]].tobytes())
    return Words(hashes, np.searchsorted(starts, bounds).astype(np.int64))


def hash_words(listed: list[str], member: np.ndarray = ALPHANUMERIC) -> np.ndarray:
    """Hashes of the words of one short text each, joined in order."""
    found = [text_words([t], member).hashes for t in listed]
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)


def text_words(texts: list[str | None], member: np.ndarray) -> Words:
    return words(*bytes_of(pa.array(texts, pa.string())), member)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string column; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, bounds) of runs of about SLICE_BYTES of text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data, bounds = bytes_of(column)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(bounds, bounds[at] + SLICE_BYTES, side="right")) - 1
        end = min(max(end, at + 1), len(column))
        yield at, data[bounds[at] : bounds[end]], bounds[at : end + 1] - bounds[at]
        at = end


def runs(found: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``width`` consecutive words of a text, and where each
    text's begin.  A text of fewer words, but not none, is one run."""
    counts, hashes = found.counts, found.hashes
    n_runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(n_runs)]).astype(np.int64)
    text = np.repeat(np.arange(len(counts)), n_runs)
    start = np.arange(first[-1]) - first[text] + found.first[text]
    length = np.minimum(counts[text], width)
    padded = np.concatenate([hashes, np.zeros(width, dtype=np.uint64)])
    total = length.astype(np.uint64) * np.uint64(_BASE)
    for k in range(width):
        total = total * np.uint64(0xA24BAED4963EE407) + np.where(k < length, padded[start + k], 0).astype(np.uint64)
    return mix(total), first


def chunks(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """(first row, end) of runs of about ``most`` bytes of text; a longer text
    is alone."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    until = offsets(lengths)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(until, until[first] + most, "right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end
        first = end


def offsets(sizes: np.ndarray) -> np.ndarray:
    """Where runs of these sizes begin, and the end."""
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places ``starts[k]`` to ``starts[k] + sizes[k]`` for each k, in a row."""
    ends = np.cumsum(sizes)
    n = int(ends[-1]) if len(ends) else 0
    return np.arange(n) + np.repeat(starts - (ends - sizes), sizes)
