"""Documents packed into as few token sequences as possible, with certified bin counts.

1. **Tokens.** Texts are cut before each ASCII space that follows a character that
   is surely no space, and before a mark that follows a letter.  The tokenizer's own
   splitting never joins across such a place, so the distinct segments of a chunk are encoded once each and the ids of
   a text are those of its segments, one after another.  Segments of Latin letters
   go through tiktoken with the merges of the tokenizer's file (the same ids, several
   times faster), all others through tokenizers.  ``END`` closes a document.
2. **Pieces.** A document of at most ``capacity`` ids is one piece.  A longer one is
   cut from its end into pieces of ``capacity``; only the first may be shorter.
   Full pieces are sequences of their own.
3. **Best-fit decreasing** packs the others, in partitions of about ``part_items``.
4. **Certificates.** Dual feasible functions give a lower bound for each
   partition's sequences.  A partition that reaches its bound is certified.
5. **Exchange.** While all sequences together are above the bound of all pieces
   together, partitions with gaps (all partitions, if none has one) give the pieces
   of their unfilled sequences into new, mixed partitions, and these are packed
   again.  A round that saves nothing is thrown away and ends the exchange.

Edges: a null text counts as empty, so it is one piece holding ``END``; null and
repeated ids are rows of their own; ties of length go by row number, so reruns agree;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lagoon.llm import textbatch as tb
from lagoon.llm.tables import stored

CAPACITY = 2048
END = 0
PART_ITEMS = 25_000
ROUNDS = 6
#: Segments a Python worker remembers; the others are encoded again in each chunk.
REMEMBERED = 500_000

_PIECE = "_row long, doc_id long, piece int, start long, length long, ids_crc32 long"
#: Byte classes: blank, surely no space, mark, ASCII letter, first of two bytes, other byte of a character.
_B, _S, _M, _L, _T, _H = 1, 2, 4, 8, 16, 32
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(28), *range(32, 128)]] = _S
_CLASS[[32, *range(9, 14)]] = _B
_CLASS[list(b".,;:!?")] |= _M
_CLASS[[*range(65, 91), *range(97, 123)]] |= _L
_CLASS[0xC3:0xE0] = _T
_CLASS[0x80:0xC0] = _H
#: What tiktoken gets: at most one space, then characters below U+0250, whose classes every Unicode version agrees on.
_PLAIN = re.compile(r" ?[\x21-\x7e\xa1-\u024f]+")
_KNOWN: dict[int, tuple[Segments, dict[str, bytes]]] = {}


# ---------------------------------------------------------------- tokens


class Segments:
    """Ids of segments, by a tokenizer file of byte-level merges."""

    def __init__(self, spec: str) -> None:
        self.whole = Tokenizer.from_str(spec)
        said = json.loads(spec)
        self.special = tuple(t["content"] for t in said["added_tokens"])
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in said["model"]["vocab"].items() if t not in self.special}
        self.fast = tiktoken.Encoding("merges", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.line = ranks[b"\n"]
        if any(re.search(r"[\s.,;:!?]", t) for t in self.special):
            raise ValueError("a special token holds a blank or a mark at which texts are cut")

    def ids(self, segments: list[str]) -> list[bytes]:
        """The little-endian unsigned 32-bit ids of each segment."""
        plain = [i for i, s in enumerate(segments) if _PLAIN.fullmatch(s) and not any(t in s for t in self.special)]
        out: list[bytes | None] = [None] * len(segments)
        # A line end before a blank or another sign, and after one, is always a token of its own.
        joined = np.array(self.fast.encode_ordinary("".join([segments[i] + "\n" for i in plain])), "<u4")
        ends = (4 * np.flatnonzero(joined == self.line)).tolist()
        raw, at = joined.tobytes(), 0
        for i, end in zip(plain, ends, strict=True):
            out[i] = raw[at:end]
            at = end + 4
        rest = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(rest, self.whole.encode_batch([segments[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = array("I", e.ids).tobytes()
        return out


def _tokenizer(spec: str) -> tuple[Segments, dict[str, bytes]]:
    """The tokenizer of this worker and its remembered segments."""
    key = zlib.crc32(spec.encode())
    if key not in _KNOWN:
        _KNOWN[key] = (Segments(spec), {})
    return _KNOWN[key]


def segment_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where segments begin: at each text, and at an ASCII space after a character that is surely no space."""
    if not len(data):
        return np.zeros(0, np.int64)
    kind = _CLASS[data]
    after, now = kind[:-1], kind[1:]
    cut = np.zeros(len(data), dtype=bool)
    cut[1:] = ((now & _B) != 0) & ((after & _S) != 0) | ((now & _M) != 0) & ((after & _L) != 0)
    cut[2:] |= ((kind[2:] & _B) != 0) & ((kind[1:-1] & _H) != 0) & ((kind[:-2] & _T) != 0)
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(cut)


def encode(spec: str, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each closed by ``END``, joined; and the n + 1 offsets into them."""
    tokenizer, known = _tokenizer(spec)
    starts = segment_starts(data, offsets)
    edges = np.append(starts, len(data)).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data)))
    found = words.dictionary_encode()
    segments = found.dictionary.to_numpy(zero_copy_only=False).tolist()
    ids = [known.get(s) for s in segments]
    new = [i for i, x in enumerate(ids) if x is None]
    for i, said in zip(new, tokenizer.ids([segments[i] for i in new]), strict=True):
        ids[i] = said
        if len(known) < REMEMBERED:
            known[segments[i]] = said
    ids.append(np.array([END], "<u4").tobytes())
    flat = np.frombuffer(b"".join(ids), "<u4")
    sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    begins = np.cumsum(sizes) - sizes
    per_text = np.diff(np.searchsorted(starts, offsets))
    code = np.insert(found.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(per_text), len(ids) - 1)
    n = sizes[code]
    at = np.cumsum(n) - n
    tokens = flat[np.repeat(begins[code] - at, n) + np.arange(int(n.sum()))]
    closing = np.flatnonzero(code == len(ids) - 1)
    return tokens, np.concatenate([[0], (at + n)[closing]])


def _cut(spec, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.chunks(batch, "text", 4 * tb.CHUNK_BYTES):
                tokens, at = encode(spec.value, *tb.utf8(part.column("text")))
                rows = np.arange(part.num_rows)
                n = np.diff(at)
                first = np.where(n > capacity, (n - 1) % capacity + 1, n)
                count = 1 + (n - first) // capacity
                row = np.repeat(rows, count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = np.where(piece > 0, first[row] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, first[row])
                lo = at[row] + start
                crc = [zlib.crc32(tokens[a:b]) for a, b in zip(lo.tolist(), (lo + length).tolist(), strict=True)]
                out = [part.column("_row").take(pa.array(row)), part.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["_row", "doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)), pa.int32()), pa.array(tokens, pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)
    return run


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """``_row, doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every piece of every document.

    ``path`` names a tokenizer file; ``_row`` numbers the rows of ``docs`` as they are read.
    """
    spark = docs.sparkSession
    tb.small_batches(spark)
    with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_cut(spec, capacity, with_ids), _PIECE + (", ids array<int>" if with_ids else ""))


# ---------------------------------------------------------------- bins


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing of ``counts[size]`` items needs, by three families of dual feasible functions.

    A dual feasible function maps sizes so that what fits into one bin sums to at
    most 1 afterwards; so the mapped sizes' total is a lower bound.  All sums are integers.
    """
    sizes = np.flatnonzero(counts)
    sizes = sizes[sizes > 0].astype(np.int64)
    if not len(sizes):
        return 0
    n = counts[sizes].astype(np.int64)
    best = -(-int((n * sizes).sum()) // capacity)
    for eps in range(1, capacity // 2 + 1):
        small, large = sizes < eps, sizes > capacity - eps
        rounded = np.where(large, capacity, np.where(small, 0, sizes))
        best = max(best, -(-int((n * rounded).sum()) // capacity))
        steps = capacity // eps
        stepped = np.where(2 * sizes > capacity, steps - (capacity - sizes) // eps, np.where(small, 0, 1))
        best = max(best, -(-int((n * stepped).sum()) // steps))
    for k in range(1, min(capacity, 100)):
        exact = (k + 1) * sizes % capacity == 0
        scaled = np.where(exact, k * sizes, (k + 1) * sizes // capacity * capacity)
        best = max(best, -(-int((n * scaled).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every item (``sizes`` falling), and the free space of every bin."""
    bins, offsets, free = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), []
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0  # bit s: a bin with free space s exists
    for i, size in enumerate(sizes.tolist()):
        fits = some >> size
        if fits and size:
            space = size + (fits & -fits).bit_length() - 1
            b = by_space[space].pop()
            if not by_space[space]:
                some ^= 1 << space
        else:
            space, b = capacity, len(free)
            free.append(capacity)
        bins[i], offsets[i] = b, capacity - space
        left = space - size
        free[b] = left
        if left:
            by_space[left].append(b)
            some |= 1 << left
    return bins, offsets, np.array(free, np.int64)


def _pack(capacity: int, step: int):
    names = ["_row", "doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        have = [b.select(names) for b in batches if b.num_rows]
        if not have:
            return
        table = pa.Table.from_batches(have).sort_by([("length", "descending"), ("_row", "ascending"), ("piece", "ascending")])
        sizes = table["length"].to_numpy()
        bins, offsets, free = best_fit_decreasing(sizes, capacity)
        gap = len(free) - lower_bound(np.bincount(sizes, minlength=capacity + 1), capacity)
        base = (step << 56) | (TaskContext.get().partitionId() << 32)
        for name, values in (("sequence_id", bins + base), ("offset", offsets), ("_free", free[bins]), ("_gap", np.full(len(bins), gap))):
            table = table.append_column(name, pa.array(values, pa.int64()))
        yield from table.combine_chunks().to_batches(max_chunksize=10_000)
    return run


def _bins(placed: DataFrame) -> int:
    return placed.where("offset = 0").count()


def _dealt(items: DataFrame, part_items: int, step: int, capacity: int) -> DataFrame:
    parts = max(1, -(-items.count() // part_items))
    mixed = items.select("_row", "doc_id", "piece", "start", "length", "ids_crc32").repartition(
        parts, F.xxhash64(F.lit(step), "_row", "piece"))
    return stored(mixed.mapInArrow(_pack(capacity, step), f"{_PIECE}, sequence_id long, offset long, _free long, _gap long"))


def packed(cut: DataFrame, capacity: int = CAPACITY, part_items: int = PART_ITEMS, rounds: int = ROUNDS) -> DataFrame:
    """A table of pieces (see ``pieces``) with ``sequence_id`` and ``offset``; extra columns of it are left out.

    ``part_items`` bounds what one task packs; after ``rounds`` exchanges the packing stays as it is.
    """
    cut = stored(cut.select("_row", "doc_id", "piece", "start", "length", "ids_crc32"))
    whole = cut.where(F.col("length") >= capacity)
    full = whole.select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    items = cut.where(F.col("length") < capacity)
    counts = np.zeros(capacity + 1, np.int64)
    for r in items.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["count"]
    bound = lower_bound(counts, capacity)
    now = _dealt(items, part_items, 1, capacity)
    settled: list[DataFrame] = []
    bins = _bins(now)
    for step in range(2, rounds + 2):
        if bins == bound:
            break
        gaps = F.col("_gap") > 0 if now.where("_gap > 0 AND _free > 0").limit(1).count() else F.lit(True)
        open_ = gaps & (F.col("_free") > 0)
        pool = now.where(open_)
        was = _bins(pool)
        again = _dealt(pool, part_items, step, capacity)
        saved = was - _bins(again)
        if saved <= 0:
            break
        settled.append(now.where(~open_))
        now, bins = again, bins - saved
    for part in settled:
        now = now.unionByName(part)
    return full.unionByName(now.select(*full.columns))


def sequences(cut: DataFrame, placed: DataFrame) -> DataFrame:
    """``sequence_id`` and its ``ids``, from pieces with their ids and their places."""
    rows = cut.select("_row", "piece", "ids").join(placed.select("_row", "piece", "sequence_id", "offset"), ["_row", "piece"])
    return rows.groupBy("sequence_id").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
