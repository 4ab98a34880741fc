"""Vectorised text helpers for Arrow batches (used inside ``mapInArrow`` tasks).

Words are maximal runs of bytes outside ``\\x20\\x09-\\x0D``.  Nothing here
loops over characters in Python; memory is a small multiple of the chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19
BATCH_ROWS = 1000

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RNG = np.random.default_rng(20240501)
_TABLE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_POWERS: dict[int, np.ndarray] = {}


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets (null counts as empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type == pa.null():
        column = column.cast(pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    buffers = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(buffers[1], dtype=width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, text_col: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``limit`` text bytes; a longer text is a slice of its own."""
    _, offsets = utf8(batch.column(batch.schema.get_field_index(text_col)))
    start, rows = 0, batch.num_rows
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield batch.slice(start, stop - start)
        start = stop


def small_batches(spark) -> None:
    """Texts go to Python ``BATCH_ROWS`` rows at a time (a session setting read when a plan runs)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text index of every word; words never cross texts."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    solid = ~_SPACE[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[0] = True
    np.logical_not(solid[:-1], out=before[1:])
    starts = np.flatnonzero(solid & (before | first[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1] = True
    np.logical_not(solid[1:], out=after[:-1])
    ends = np.flatnonzero(solid & (after | first[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if size <= 16 * CHUNK_BYTES:
            _POWERS[base] = have
    return have[:n]


def mix64(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash: n + 1 values; see ``span_hashes``."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[data] * _powers(_BASE, len(data)), out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, equal for equal bytes."""
    raw = (prefix[ends] - prefix[starts]) * _powers(_INVERSE, len(prefix))[starts]
    return mix64(raw + (ends - starts).astype(np.uint64))


def combine(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for i in range(1, width):
        out = out * _MIX + hashes[i:i + n]
        out ^= out >> np.uint64(29)
    return mix64(out)
