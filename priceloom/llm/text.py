"""Vectorised text handling for Arrow batches: words, hashes, shingle sets.

Words are runs of bytes other than space and \\x09-\\x0D, letters A-Z count as
a-z, and everything works on the UTF-8 bytes of whole texts. Nothing here
touches Spark; the functions run inside ``mapInArrow`` tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
_R = 0x9E3779B97F4A7C15
_R_INVERSE = pow(_R, -1, 1 << 64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_ORDER = mix(np.arange(1001, 1065, dtype=np.uint64)) | np.uint64(1)
_powers = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        ups, downs = (np.full(size, x, dtype=np.uint64) for x in (_R, _R_INVERSE))
        ups[0] = downs[0] = 1
        _powers = np.multiply.accumulate(ups), np.multiply.accumulate(downs)
    return _powers


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each slice has about ``limit`` text bytes, one row at
    least, so memory follows the limit and the longest text only."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(lengths.astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)


def joined_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One byte array for all texts, and where each starts; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first, last = int(starts[0]), int(starts[-1])
    whole = np.frombuffer(data, dtype=np.uint8)[first:last] if last > first else np.zeros(0, dtype=np.uint8)
    return whole, starts - first


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of true bytes that stay within a text: starts, ends, and for each
    text the number of the first run."""
    if not len(inside):
        return (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(len(offsets), dtype=np.int64),)
    edge = np.zeros(len(inside) + 1, dtype=bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return runs(~SPACE[data], offsets)


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte runs: a polynomial over random byte values, from
    running sums. Works in pieces of CHUNK_BYTES, or of one longer run."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + CHUNK_BYTES, side="right")))
        piece = data[base : int(ends[to - 1])]
        up, down = _power_table(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[piece] * up[: len(piece)], out=sums[1:])
        s = starts[at:to] - base
        out[at:to] = (sums[ends[at:to] - base] - sums[s]) * down[s]
        at = to
    return mix(out)


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words within a text, and for each text
    the number of its first one. A text of fewer words has its whole word
    sequence as one shingle; a text without words has none."""
    n, counts = len(hashes), np.diff(first)
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    begins = np.concatenate([[0], np.cumsum(sizes)])
    if n >= width:
        rolled = hashes[: n - width + 1] * _ORDER[0]
        for k in range(1, width):
            rolled += hashes[k : n - width + 1 + k] * _ORDER[k]
    else:
        rolled = np.zeros(0, dtype=np.uint64)
    out = np.empty(int(begins[-1]), dtype=np.uint64)
    full = counts >= width
    kept = np.zeros(n + 1, dtype=np.int64)
    np.add.at(kept, first[:-1][full], 1)
    np.add.at(kept, (first[1:] - width + 1)[full], -1)
    inside = np.cumsum(kept[:n]) > 0
    place = np.repeat(full, sizes)
    out[place] = mix(rolled[inside[: len(rolled)]])
    for i in np.flatnonzero((counts > 0) & ~full):
        part = hashes[first[i] : first[i + 1]]
        out[begins[i]] = mix((part * _ORDER[: len(part)]).sum(dtype=np.uint64)[None] + _ORDER[63 - len(part)])[0]
    return out, begins


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    data, offsets = joined_bytes(texts)
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    values, begins = shingles(hash_runs(data, starts, ends), first, width)
    out = []
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
        part = np.sort(values[a:b])
        out.append(part[np.concatenate([[True], part[1:] != part[:-1]])] if b - a > 1 else part)
    return out
