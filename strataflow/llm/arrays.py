"""Numpy helpers for tasks: the texts of an Arrow batch as one byte buffer, hashed word by word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
#: For work that has many numbers for each byte: a worker keeps the memory of its largest arrays for the stages that come after.
SMALL_SLICE = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, at least ``n`` + 1 of each."""
    if len(_powers[0]) <= n:
        size = 1 << (n + 1).bit_length()
        base = 0x2545F4914F6CDD1D
        for k, number in enumerate((base, pow(base, -1, 1 << 64))):
            steps = np.full(size, number, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def slices(column: pa.ChunkedArray | pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows in runs of at most ``most`` bytes (a longer text is a run of its own).

    Yields first row, end row, the bytes of these rows and their offsets. Nulls are empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if not n:
        return
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + n + 1]
    everything = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, everything[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """``pre`` such that ``substring_hashes`` finds the hash of any substring from it."""
    power, _ = _powers_to(len(data))
    pre = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * power[: len(data)], out=pre[1:])
    return pre


def substring_hashes(pre: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, inverse = _powers_to(len(pre))
    return mix((pre[end] - pre[start]) * inverse[start] + (end - start).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words ``[^\\x20\\x09-\\x0D]+`` and, per text, where its words begin in them."""
    inside = ~_SPACE[data]
    before = np.empty(len(data), dtype=bool)
    after = np.empty(len(data), dtype=bool)
    if len(data):
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[0] = after[-1] = False
        cuts = offsets[offsets < len(data)]
        before[cuts] = False
        after[cuts[cuts > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One 64-bit hash per word and, per text, where its words begin."""
    starts, ends, bounds = words(data, offsets)
    return substring_hashes(prefix_hashes(data), starts, ends), bounds


def owners(bounds: np.ndarray) -> np.ndarray:
    """For each element the text it belongs to."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def shingles(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``k`` consecutive words of a text; a text with fewer words has one of all its words."""
    sizes = np.diff(bounds)
    counts = np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1))
    out_bounds = np.concatenate(([0], np.cumsum(counts)))
    first = np.repeat(bounds[:-1] - out_bounds[:-1], counts) + np.arange(out_bounds[-1])
    last = np.repeat(bounds[1:], counts)
    total = np.zeros(len(first), dtype=np.uint64)
    for j in range(k):
        at = first + j
        have = at < last
        word = hashes[np.minimum(at, max(len(hashes) - 1, 0))] if len(hashes) else total
        total = np.where(have, mix(total * _ODD + word + np.uint64(j)), total)
    return total, out_bounds


def occurrence_labels(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each gram joined with how often it stood earlier in its text: equal grams get different labels."""
    own = owners(bounds).astype(np.uint64)
    key = mix(grams + mix(own + np.uint64(1)))
    ordered = np.sort(key)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    number = np.zeros(len(grams), dtype=np.uint64)
    if len(again):
        again = np.unique(again)
        near = np.minimum(np.searchsorted(again, key), len(again) - 1)
        at = np.flatnonzero(again[near] == key)
        at = at[np.argsort(key[at], kind="stable")]
        runs = key[at]
        new = np.concatenate(([True], runs[1:] != runs[:-1]))
        place = np.arange(len(at))
        number[at] = (place - np.maximum.accumulate(np.where(new, place, 0))).astype(np.uint64)
    return mix(grams + number * _ODD)


def order_minhash(labels: np.ndarray, bounds: np.ndarray, count: int, length: int, seed: int = 1) -> np.ndarray:
    """Order MinHash: ``count`` 64-bit hashes per text.

    For each of ``count`` random orders the ``length`` least labelled grams of a text are taken and hashed
    in the order in which they stand in the text. A text with fewer grams uses all it has; one
    without any has zeros.
    """
    n = len(bounds) - 1
    out = np.zeros((n, count), dtype=np.uint64)
    filled = np.flatnonzero(np.diff(bounds) > 0)
    if not len(filled):
        return out
    begin = bounds[:-1][filled]
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    # a number holds the upper bits of a random hash and, below them, the place: the least one tells its place
    mask = np.uint64((1 << max(len(labels) - 1, 1).bit_length()) - 1)
    index = np.arange(len(labels), dtype=np.uint64)
    salts = mix(np.arange(1, count + 1, dtype=np.uint64) * _ODD + np.uint64(seed))
    value = np.empty_like(labels)
    shifted = np.empty_like(labels)
    for c in range(count):
        np.bitwise_xor(labels, salts[c], out=value)
        np.multiply(value, np.uint64(0xD6E8FEB86659FD93), out=value)
        np.right_shift(value, np.uint64(32), out=shifted)
        np.bitwise_xor(value, shifted, out=value)
        np.bitwise_and(value, ~mask, out=value)
        np.bitwise_or(value, index, out=value)
        places = np.full((len(filled), length), len(labels), dtype=np.int64)
        for j in range(length):
            least = np.minimum.reduceat(value, begin)
            have = least != top
            places[have, j] = (least[have] & mask).astype(np.int64)
            value[places[have, j]] = top
        places.sort(axis=1)
        total = np.full(len(filled), salts[c], dtype=np.uint64)
        for j in range(length):
            have = places[:, j] < len(labels)
            gram = labels[np.minimum(places[:, j], len(labels) - 1)]
            total = np.where(have, mix(total * _ODD + gram), total)
        out[filled, c] = total
    return out
