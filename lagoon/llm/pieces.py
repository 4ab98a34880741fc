"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The pieces of a model file are read on the driver (their path is a parameter) and
broadcast as arrays: a double-array trie over their UTF-8 bytes, with the white
space marker as one space byte, and a log score per piece.  A unigram model's
scores are used as they are; a merge model's scores are ranks, from which
Zipf-like log probabilities are made.

Texts get one leading space and are cut into units at spaces and line ends.  No
piece crosses these cuts (checked when the model is read), so the best path of a
text is the chain of its units' best paths.  Distinct units of a chunk are found
by hash, matched against the trie from all positions at once, and solved
together, position by position; long units one by one.  A character without a
piece of its own costs the worst score less 10 and becomes its byte pieces.

Decoding joins the pieces' bytes, markers back to spaces, less the leading
space; a marker character in the text itself is encoded by its bytes, so every
text comes back exactly.

Nulls and edges: a null or empty text has no tokens and decodes to an empty
text; ties go to the longer last piece; there is no limit on a text's length;
repeated rows are encoded row by row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagoon.llm import textbatch as tb

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
LONG_UNIT = 40
BLOCK_BYTES = 1 << 17
NEVER = np.float64(-1e18)


@dataclass
class Pieces:
    """The model as arrays: trie, scores, bytes per piece id."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    score: np.ndarray
    byte_id: np.ndarray
    flat: np.ndarray
    offsets: np.ndarray
    unknown: float
    longest: int


def double_array(keys: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``base``, ``check`` and ``value`` of a trie: from state s, byte c leads to base[s] + c + 1 if check there is s."""
    children: list[dict[int, int]] = [{}]
    ends: dict[int, int] = {}
    for key, ident in keys.items():
        node = 0
        for c in key:
            nxt = children[node].get(c)
            if nxt is None:
                children.append({})
                nxt = children[node][c] = len(children) - 1
            node = nxt
        ends[node] = ident
    size = 2 * len(children) + 8192
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    used = np.zeros(size, dtype=bool)
    used[:300] = True                       # a base is then never 0
    single, dense = 300, 300                # searches start here: one child, several children
    queue = deque([(0, 0)])
    while queue:
        node, state = queue.popleft()
        if node in ends:
            value[state] = ends[node]
        codes = np.array(sorted(children[node]), np.int64)
        if not len(codes):
            continue
        if len(codes) == 1:
            while used[single]:
                single += 1
            at = single - int(codes[0]) - 1
        else:
            at, tried = -1, dense
            while at < 0:
                if tried + 3000 > len(used):
                    more = len(used)
                    used = np.concatenate([used, np.zeros(more, dtype=bool)])
                    base, check, value = (np.concatenate([x, np.full(more, f, np.int32)])
                                          for x, f in ((base, 0), (check, -1), (value, -1)))
                starts = np.arange(tried, tried + 2048)
                fits = np.flatnonzero(~used[starts[:, None] + codes + 1].any(axis=1))
                if len(fits):
                    at = int(starts[fits[0]])
                else:
                    tried += 2048
                    if used[tried - 2048:tried].mean() > 0.9:
                        dense = tried
        base[state] = at
        for c in codes.tolist():
            used[at + c + 1] = True
            check[at + c + 1] = state
            queue.append((children[node][c], at + c + 1))
        if single + 300 > len(used):
            used = np.concatenate([used, np.zeros(8192, dtype=bool)])
            base, check, value = (np.concatenate([x, np.full(8192, f, np.int32)]) for x, f in ((base, 0), (check, -1), (value, -1)))
    top = int(np.flatnonzero(used).max()) + 300
    return tuple(np.concatenate([x, np.full(max(0, top - len(x)), f, np.int32)])[:top]
                 for x, f in ((base, 0), (check, -1), (value, -1)))


def load(path: str = MODEL) -> Pieces:
    """Read a SentencePiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(n)]
    normal = [i for i in range(n) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
    score = np.array([model.get_score(i) for i in range(n)], np.float64)
    own = score[normal]
    if len(own) and (own == np.round(own)).all():
        rank = -own - (-own).min()
        score[normal] = -np.log(rank + 10.0) - np.log(np.sum(1.0 / (rank + 10.0)))
    raw = [names[i].replace(MARK, " ").encode() for i in range(n)]
    keys = {}
    for i in normal:
        text = raw[i]
        if b"\n" in text or b" " in text.lstrip(b" "):
            raise ValueError(f"piece {names[i]!r} crosses a unit boundary")
        keys[text] = i
    byte_id = np.full(256, -1, np.int32)
    for i in range(n):
        if model.is_byte(i):
            byte_id[int(names[i][3:5], 16)] = i
            raw[i] = bytes([int(names[i][3:5], 16)])
        elif model.is_control(i) or model.is_unknown(i):
            raw[i] = b""
    if (byte_id < 0).any():
        raise ValueError("the model has no byte pieces")
    base, check, value = double_array(keys)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return Pieces(base, check, value, score, byte_id, np.frombuffer(b"".join(raw), np.uint8), offsets,
                  float(score[normal].min()) - 10.0, max(map(len, keys)))


def _char_sizes(data: np.ndarray) -> np.ndarray:
    """Bytes of the UTF-8 character that starts here; 0 inside a character."""
    return np.select([data < 0x80, data < 0xC0, data < 0xE0, data < 0xF0], [1, 0, 2, 3], 4).astype(np.int64)


def _matches(p: Pieces, data: np.ndarray, left: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per length d: positions with a piece of d bytes, and its id.  ``left``: bytes to the end of the unit."""
    at, state, out = np.arange(len(data)), np.zeros(len(data), np.int64), []
    for d in range(1, p.longest + 1):
        ok = left[at] >= d
        at, state = at[ok], state[ok]
        nxt = p.base[state] + data[at + d - 1] + 1
        ok = (p.check[nxt] == state) & (p.base[state] > 0)
        at, state = at[ok], nxt[ok]
        if not len(at):
            break
        ids = p.value[state]
        hit = ids >= 0
        out.append((at[hit], ids[hit]))
    return out


def _solve(p: Pieces, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all units, joined, and the number per unit.  Units lie one after another in ``data``."""
    n = len(data)
    ends = starts + sizes
    unit_end = np.repeat(ends, sizes)
    left = unit_end - np.arange(n)
    found = _matches(p, data, left)
    char = _char_sizes(data)
    one = np.zeros(n, dtype=bool)
    for d, (at, _) in enumerate(found, 1):
        one[at[char[at] == d]] = True
    bare = np.flatnonzero((char > 0) & ~one & (char <= left))
    # Edges sorted by start: (start, size, id or -1 for a bare character, score).
    start = np.concatenate([*[a for a, _ in found], bare])
    size = np.concatenate([*[np.full(len(a), d) for d, (a, _) in enumerate(found, 1)], char[bare]])
    ident = np.concatenate([*[i for _, i in found], np.full(len(bare), -1, np.int32)])
    gain = np.where(ident >= 0, p.score[ident], p.unknown)
    offset = start - np.repeat(starts, sizes)[start]          # position inside the unit
    short = np.repeat(sizes <= LONG_UNIT, sizes)[start]
    best, via, token = np.full(n + len(starts) + 1, NEVER), np.zeros(n + len(starts) + 1, np.int64), np.full(n + len(starts) + 1, -1, np.int64)
    node = np.arange(n) + np.repeat(np.arange(len(starts)), sizes)  # one node per byte boundary, size + 1 per unit
    first = starts + np.arange(len(starts))
    best[first] = 0.0
    order = np.lexsort((size, offset))
    order = order[short[order]]
    cuts = np.searchsorted(offset[order], np.arange(LONG_UNIT + 1))
    for j in range(LONG_UNIT):
        for_j = order[cuts[j]:cuts[j + 1]]
        if not len(for_j):
            continue
        lens = size[for_j]
        breaks = np.flatnonzero(np.diff(lens)) + 1
        for group in np.split(for_j, breaks):                 # one size: targets are distinct
            a = node[start[group]]
            b = a + size[group]
            value = best[a] + gain[group]
            better = value > best[b]
            g, t = group[better], b[better]
            best[t], via[t], token[t] = value[better], a[better], ident[g]
    longs = np.flatnonzero(~short)
    if len(longs):
        for e in longs[np.lexsort((size[longs], start[longs]))].tolist():
            a = int(node[start[e]])
            b, value = a + int(size[e]), best[a] + gain[e]
            if value > best[b]:
                best[b], via[b], token[b] = value, a, ident[e]
    # Walk back from all unit ends at once.
    at = ends + np.arange(len(starts))
    origin = np.repeat(np.arange(len(starts)), sizes + 1)
    steps_at, steps_from = [], []
    live = np.flatnonzero(at > first)
    at = at[live]
    while len(at):
        steps_at.append(at)
        steps_from.append(via[at])
        at = via[at]
        at = at[at > first[origin[at]]]
    if not steps_at:
        return np.zeros(0, np.int32), np.zeros(len(starts), np.int64)
    done, back = np.concatenate(steps_at), np.concatenate(steps_from)
    turn = np.argsort(done, kind="stable")
    done, back = done[turn], back[turn]
    ids, widths = token[done], done - back
    bare = ids < 0
    count = np.where(bare, widths, 1)
    out = np.repeat(ids, count)
    where = np.repeat(bare, count)
    if where.any():
        byte_at = np.repeat(back - origin[back], count) + np.arange(len(out)) - np.repeat(np.cumsum(count) - count, count)
        out[where] = p.byte_id[data[byte_at[where]]]
    return out.astype(np.int32), np.bincount(origin[done], weights=count, minlength=len(starts)).astype(np.int64)


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of many runs, one after another."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def encode(p: Pieces, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts, joined, and the n + 1 offsets into them."""
    lens = np.diff(offsets)
    full = np.flatnonzero(lens > 0)
    if not len(full):
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    begin = offsets[:-1][full]
    data = np.insert(data, begin, 32)
    begin = begin + np.arange(len(full))
    space, line = data == 32, data == 10
    cut = np.zeros(len(data), dtype=bool)
    cut[1:] = (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
    cut[begin] = True
    starts = np.flatnonzero(cut)
    sizes = np.diff(np.append(starts, len(data)))
    keys = tb.span_hashes(tb.prefix_hashes(data), starts, starts + sizes)
    _, pick, which = np.unique(keys, return_index=True, return_inverse=True)
    parts, counts = [], np.zeros(len(pick), np.int64)
    total, i = np.cumsum(sizes[pick]), 0
    while i < len(pick):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + BLOCK_BYTES, side="right")))
        s = sizes[pick[i:j]]
        units = data[_gather(starts[pick[i:j]], s)]
        ids, n = _solve(p, units, np.cumsum(s) - s, s)
        parts.append(ids)
        counts[i:j] = n
        i = j
    flat = np.concatenate(parts)
    begins = np.cumsum(counts) - counts
    n = counts[which]
    tokens = flat[_gather(begins[which], n)]
    owner = np.searchsorted(begin, starts, side="right") - 1
    per_text = np.zeros(len(offsets) - 1, np.int64)
    per_text[full] = np.bincount(owner, weights=n, minlength=len(full)).astype(np.int64)
    return tokens, np.concatenate([[0], np.cumsum(per_text)])


def decode(p: Pieces, tokens: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all token lists, joined, and their offsets (the leading space is taken off)."""
    sizes = (p.offsets[1:] - p.offsets[:-1])[tokens]
    data = p.flat[_gather(p.offsets[:-1][tokens], sizes)]
    upto = np.concatenate([[0], np.cumsum(sizes)])[offsets]
    full = np.flatnonzero(np.diff(upto) > 0)
    lead = upto[:-1][full]
    lead = lead[data[lead] == 32]
    keep = np.ones(len(data), dtype=bool)
    keep[lead] = False
    drop = np.zeros(len(upto) - 1, np.int64)
    drop[np.searchsorted(upto, lead, side="right") - 1] = 1
    return data[keep], upto - np.concatenate([[0], np.cumsum(drop)])


def _encoded(model, text_col: str, keep: list[str], digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = model.value
        is_byte = np.zeros(len(p.score), dtype=bool)
        is_byte[p.byte_id] = True
        for batch in batches:
            for part in tb.chunks(batch, text_col):
                data, offsets = tb.utf8(part.column(text_col))
                tokens, at = encode(p, data, offsets)
                back, ends = decode(p, tokens, at)
                n = np.diff(at)
                same = np.diff(ends) == np.diff(offsets)
                if not (same.all() and np.array_equal(back, data)):
                    same = np.array([same[i] and np.array_equal(back[ends[i]:ends[i + 1]], data[offsets[i]:offsets[i + 1]])
                                     for i in range(len(n))])
                owner = np.repeat(np.arange(len(n)), n)
                bytes_used = np.bincount(owner, weights=is_byte[tokens], minlength=len(n)).astype(np.int64)
                out = [*[part.column(c) for c in keep], pa.array(n, pa.int64()), pa.array(bytes_used, pa.int64()), pa.array(same, pa.bool_())]
                if digest:
                    little = tokens.astype("<i4")
                    out.append(pa.array([hashlib.sha256(little[at[i]:at[i + 1]].tobytes()).hexdigest() for i in range(len(n))], pa.string()))
                else:
                    out.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(tokens, pa.int32())))
                yield pa.RecordBatch.from_arrays(out, names=[*keep, "n_tokens", "n_byte_tokens", "round_trip", "ids_sha256" if digest else "token_ids"])
    return run


def encoded(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", path: str = MODEL,
            digest: bool = False) -> DataFrame:
    """``keep`` columns, ``n_tokens``, ``n_byte_tokens``, ``round_trip`` and ``token_ids`` (or their ``ids_sha256``)."""
    tb.small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(load(path))
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    last = "ids_sha256 string" if digest else "token_ids array<int>"
    return docs.select(*keep, text_col).mapInArrow(
        _encoded(model, text_col, list(keep), digest), f"{fields}, n_tokens long, n_byte_tokens long, round_trip boolean, {last}")


def decoded(rows: DataFrame, keep: tuple[str, ...] = ("doc_id",), path: str = MODEL) -> DataFrame:
    """``keep`` columns and the ``text`` of ``token_ids`` (null ids count as none)."""
    model = rows.sparkSession.sparkContext.broadcast(load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.asarray(x or [], np.int64) for x in batch.column("token_ids").to_pylist()]
            at = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            data, ends = decode(model.value, np.concatenate([*lists, np.zeros(0, np.int64)]), at)
            raw = data.tobytes()
            texts = [raw[ends[i]:ends[i + 1]].decode("utf-8", "replace") for i in range(len(lists))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(texts, pa.string())], names=[*keep, "text"])

    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select(*keep, F.col("token_ids").cast("array<int>").alias("token_ids")).mapInArrow(run, f"{fields}, text string")
