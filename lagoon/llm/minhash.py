"""Near duplicates by b-bit MinHash: banded candidates, packed signatures, exact confirmation.

1. Each text becomes a set of word shingles (64-bit hashes).  Equal sets form
   one *class*, named by a 128-bit digest, so exact copies cost one row.
2. ``PERMUTATIONS`` minima per class: bands of ``BAND_ROWS`` full minima give
   bucket keys, the low 8 bits of each minimum are packed as the signature.
3. A star round names a pivot in every bucket and estimates the similarity of
   each class in another component to it from the signatures, corrected for
   chance equality of 8-bit values.  A class's best pivot that is near enough to
   the threshold is confirmed on full sets; confirmed links are closed into
   components (after the first round only drawn together).  The first round reads ``FIRST_BANDS`` bands; ``STAR_ROUNDS`` more
   read those buckets of all bands that still hold two components, and
   take the pivot from the bucket's largest one.  Only (bucket, class) is shuffled
   by bucket, and signatures once per (class, pivot).
4. What is still apart inside a bucket is compared block by block: the classes
   outside the bucket's largest component with all its classes (a large bucket is
   cut into blocks of about ``BLOCK`` classes and at most about ``BLOCK_SHINGLES`` shingles,
   one task per pair of blocks).  A first pass names the classes of a task that have a pair from
   different components, in the first band it shares, that passes the estimate.  Only their full sets
   go to the task again, which confirms the pairs itself and returns a link wherever two components
   meet: fewer links than classes, however many pairs pass.  All links are closed
   into components at the end.  Links inside a component would change nothing, so no link between different texts is lost,
   and a group of k copies or near copies costs rows in proportion to k and its blocks, not k * k.

A pair of similarity 0.8 shares no band with probability (1 - 0.8**4)**32 < 1e-7
and falls below the estimate margin with about 3e-6.

Nulls and edges: a null or word-less text has an empty set and is linked with
nothing (its component is its own id); fewer words than the shingle width make
one shingle of the whole sequence; rows with a null id take part and get the
smallest id reachable, or null; repeated rows share a class; empty tables give
empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagoon.llm import textbatch as tb
from lagoon.llm.components import connect, drawn_in, lowest_known
from lagoon.llm.tables import small, stored

PERMUTATIONS, BAND_ROWS, LOW_BITS = 128, 4, 8
BANDS = PERMUTATIONS // BAND_ROWS
MARGIN = 0.16
BLOCK, BLOCK_SHINGLES = 256, 1 << 20
FIRST_BANDS, STAR_ROUNDS = 8, 1
_RNG = np.random.default_rng(97)
_A = _RNG.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_BAND_SALT = tb.mix64(np.arange(1, BANDS + 1, dtype=np.uint64))

_SIGNED = "row_id long, n_shingles long, class binary, signature binary, bands array<long>"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text (ASCII letters lower-cased)."""
    data = tb.lower_ascii(data)
    starts, ends, owner = tb.word_bounds(data, offsets)
    words = tb.span_hashes(tb.prefix_hashes(data), starts, ends)
    grams = tb.combine(words, width)
    bounds = np.searchsorted(owner, np.arange(len(offsets)))
    for i in range(len(offsets) - 1):
        a, b = bounds[i], bounds[i + 1]
        if b - a >= width:
            yield np.unique(grams[a:b - width + 1])
        elif b > a:
            yield tb.combine(words[a:b], int(b - a)) ^ np.uint64(b - a)
        else:
            yield np.zeros(0, np.uint64)


def _minima(shingles: np.ndarray) -> np.ndarray:
    out = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), 4096):
        np.minimum(out, (shingles[i:i + 4096, None] * _A + _B).min(axis=0), out=out)
    return out


def _sign(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.chunks(batch, "text"):
                data, offsets = tb.utf8(part.column("text"))
                sizes, classes, packed, bands = [], [], [], []
                for s in shingle_sets(data, offsets, width):
                    sizes.append(len(s))
                    if not len(s):
                        classes.append(None)
                        packed.append(None)
                        bands.append(None)
                        continue
                    m = _minima(s)
                    classes.append(xxhash.xxh128_digest(s.tobytes()))
                    packed.append((m & np.uint64(255)).astype(np.uint8).tobytes())
                    rows = m.reshape(BANDS, BAND_ROWS)
                    key = _BAND_SALT.copy()
                    for j in range(BAND_ROWS):
                        key = tb.mix64(key ^ rows[:, j])
                    bands.append(key.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row_id"), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()),
                     pa.array(packed, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["row_id", "n_shingles", "class", "signature", "bands"])
    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.chunks(batch, "text"):
                data, offsets = tb.utf8(part.column("text"))
                sets = [s.view(np.int64) for s in shingle_sets(data, offsets, width)]
                classes = [xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(classes, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["class", "members"])
    return run


def estimate(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Similarity from equal packed minima, less what chance makes equal (rows of uint8)."""
    chance = 1.0 / (1 << LOW_BITS)
    equal = (left == right).mean(axis=-1)
    return (equal - chance) / (1.0 - chance)


def _matrix(column: pa.Array, dtype: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def _to_pivot(least: float):
    """(class, pivot, estimate) of the rows that are near enough to their bucket's pivot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = estimate(*(_matrix(batch.column(c), np.uint8, PERMUTATIONS) for c in ("signature", "sig_p")))
                out = batch.select(["class", "pivot"]).append_column("near", pa.array(near))
                yield out.filter(pa.array(near >= least))
    return run


def _apart(table: pa.Table, comp: np.ndarray, lo: int, hi: int, band: int, least: float, ratio: float) -> Iterator[tuple[int, np.ndarray]]:
    """Per class i of block ``lo`` the classes of block ``hi`` in other components that pass the estimate, in the first band they share.

    ``comp`` is read anew for every class, so components that the caller joins are not compared again.
    """
    block = table.column("block").to_numpy()
    sigs = _matrix(table.column("signature"), np.uint8, PERMUTATIONS)
    tags = table.column("tags").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    size = table.column("n_shingles").to_numpy()
    one, two = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    for i in one:
        js = two[two > i] if lo == hi else two
        js = js[(comp[js] != comp[i]) & (np.minimum(size[js], size[i]) >= ratio * np.maximum(size[js], size[i]))]
        if len(js):
            js = js[estimate(sigs[js], sigs[i]) >= least]
            js = js[(tags[js] == tags[i]).argmax(axis=1) == band]
        if len(js):
            yield int(i), js


def _task(key: tuple[pa.Scalar, ...], table: pa.Table) -> tuple[np.ndarray, int, int, int]:
    """The components of a task's classes as numbers, and its blocks and band."""
    band, lo, hi = (k.as_py() for k in key[1:])
    comp = np.unique(np.array(table.column("comp").to_pylist(), dtype="S16"), return_inverse=True)[1]
    return comp, lo, hi, band


def _wanted(least: float, ratio: float):
    """The rows of one (bucket, band, block, block) task that have a pair to confirm in it."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        hit = np.zeros(table.num_rows, bool)
        for i, js in _apart(table, *_task(key, table), least, ratio):
            hit[i] = True
            hit[js] = True
        return table.filter(pa.array(hit))
    return run


def _across(least: float, ratio: float, percent: int):
    """Links (a, b) of one task, confirmed on full sets: one wherever two components meet."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        comp, *where = _task(key, table)
        members = table.column("members").combine_chunks()
        size = members.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = np.unique(members.flatten().to_numpy(), return_inverse=True)[1]
        ends = np.cumsum(size)
        mark = np.zeros(int(flat.max(initial=-1)) + 1, bool)
        found_a, found_b = [], []
        for i, js in _apart(table, comp, *where, least, ratio):
            own = flat[ends[i] - size[i]:ends[i]]
            mark[own] = True
            common = np.array([np.count_nonzero(mark[flat[ends[j] - size[j]:ends[j]]]) for j in js])
            mark[own] = False
            js = js[100 * common >= percent * (size[js] + size[i] - common)]
            met, first = np.unique(comp[js], return_index=True)
            found_a += [i] * len(first)
            found_b += js[first].tolist()
            comp[np.isin(comp, met)] = comp[i]
        names = table.column("class").combine_chunks()
        return pa.table({c: names.take(pa.array(x, pa.int64())) for c, x in (("a", found_a), ("b", found_b))})
    return run


def _sets_of(keyed: DataFrame, classes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``class, members``: the full sets of the wanted classes, made again from one text of each.

    Not stored: the shuffle that drops repeated rows is the one that joins on the class need.
    """
    rows = stored(classes.select("class", "row_id").join(wanted.distinct(), "class", "left_semi").select("row_id"))
    texts = keyed.join(small(rows), "row_id", "left_semi").select("text")
    return texts.mapInArrow(_sets(width), "class binary, members array<long>").dropDuplicates(["class"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets satisfy 100 * |A and B| >= percent * |A or B|."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    both = (pairs.join(sets.select(F.col("class").alias("a"), F.col("members").alias("set_a")), "a")
            .join(sets.select(F.col("class").alias("b"), F.col("members").alias("set_b")), "b")
            .withColumn("common", F.size(F.array_intersect("set_a", "set_b"))))
    union = F.size("set_a") + F.size("set_b") - F.col("common")
    return both.where(100 * F.col("common") >= percent * union).select("a", "b")


def _placed(member: DataFrame, label: DataFrame) -> DataFrame:
    """``member`` with the component of each class."""
    return member.join(label.toDF("class", "root"), "class", "left").withColumn("comp", F.coalesce("root", "class")).drop("root")


def _tops(placed: DataFrame, turn: int) -> DataFrame:
    """Per bucket of several components: the largest one, a pivot of it, and the rows inside and outside of it."""
    pivot = F.min(F.struct(F.xxhash64(F.lit(turn), "class").alias("order"), F.col("class").alias("pivot")))
    parts = placed.groupBy("bucket", "comp").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"), pivot.alias("p"))
    tops = parts.groupBy("bucket").agg(F.max(F.struct("n", "comp", "p.pivot", "size")).alias("top"), F.sum("n").alias("total"),
                                       F.sum("size").alias("size"), F.count("*").alias("comps")).where("comps > 1")
    return tops.select("bucket", F.col("top.comp").alias("comp_p"), "top.pivot", F.col("top.n").alias("n_top"),
                       (F.col("total") - F.col("top.n")).alias("n_apart"), F.col("top.size").alias("size_top"),
                       (F.col("size") - F.col("top.size")).alias("size_apart"))


def _nearest_pivot(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b): each class of ``pairs`` and its best pivot, if the estimate is near enough."""
    left = classes.select("class", "n_shingles", "signature")
    right = left.toDF("pivot", "n_p", "sig_p")
    both = (pairs.distinct().join(left, "class").join(right, "pivot")
            .where(100 * F.least("n_shingles", "n_p") >= percent * F.greatest("n_shingles", "n_p")))
    near = both.select("class", "pivot", "signature", "sig_p").mapInArrow(
        _to_pivot(percent / 100 - MARGIN), "class binary, pivot binary, near double")
    best = near.groupBy("class").agg(F.max(F.struct("near", "pivot")).alias("best"))
    return best.select(F.col("class").alias("a"), F.col("best.pivot").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = 4, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``, ``kept``."""
    tb.small_batches(docs.sparkSession)
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keyed = keyed.select("doc_id", F.xxhash64("doc_id", "text").alias("row_id"), "text")
    signed = stored(keyed.select("row_id", "text").mapInArrow(_sign(width), _SIGNED))
    named = signed.dropDuplicates(["row_id"]).select("row_id", "n_shingles", "class")
    classes = stored(signed.where("class IS NOT NULL").groupBy("class").agg(
        F.min("row_id").alias("row_id"), *[F.first(c).alias(c) for c in ("n_shingles", "signature", "bands")]))

    # First round: a few bands of all classes, so that large groups are one component before all bands are read.
    some = classes.select("class", F.explode(F.slice("bands", 1, FIRST_BANDS)).alias("bucket"))
    pivots = some.groupBy("bucket").agg(F.min("class").alias("pivot"), F.count("*").alias("n")).where("n > 1").drop("n")
    pairs = some.join(pivots, "bucket").where("class <> pivot").select("class", "pivot")
    near = stored(_nearest_pivot(pairs, classes, percent))

    member = classes.select("class", "n_shingles", F.posexplode("bands").alias("band", "bucket"))
    sets = _sets_of(keyed, classes, near.select(F.col("a").alias("class")).union(near.select("b")), width)
    links = drawn_in(_confirmed(near, sets, percent))

    # Only buckets that still hold several components go on.
    code = F.xxhash64("comp")
    mixed = (_placed(classes.select("class", "bands"), lowest_known(links)).select(F.explode("bands").alias("bucket"), code.alias("code"))
             .groupBy("bucket").agg(F.min("code").alias("lo"), F.max("code").alias("hi")).where("lo <> hi").select("bucket"))
    shared = stored(member.join(mixed, "bucket", "left_semi"))
    sets = _sets_of(keyed, classes, shared.select("class"), width)
    for turn in range(STAR_ROUNDS):
        placed = _placed(shared, lowest_known(links))
        tops = _tops(placed, turn).select("bucket", "comp_p", "pivot")
        pairs = placed.join(tops, "bucket").where("comp <> comp_p").select("class", "pivot")
        links = connect(links.union(_confirmed(_nearest_pivot(pairs, classes, percent), sets, percent)))

    least, ratio = percent / 100 - MARGIN, percent / 100
    placed = _placed(shared, lowest_known(links))
    cut = placed.join(_tops(placed, STAR_ROUNDS), "bucket")
    whole = (F.col("n_top") + F.col("n_apart") <= BLOCK) & (F.col("size_top") + F.col("size_apart") <= BLOCK_SHINGLES)  # one block, compared with itself
    inside, key = F.col("comp") == F.col("comp_p"), F.xxhash64("class")
    n_in, n_out = (F.ceil(F.greatest(F.col(f"n_{c}") / BLOCK, F.col(f"size_{c}") / BLOCK_SHINGLES)).cast("int") for c in ("top", "apart"))
    block = F.when(whole, 0).when(inside, F.pmod(key, n_in)).otherwise(n_in + F.pmod(key, n_out)).cast("int")
    others = F.when(whole, F.array(F.lit(0))).otherwise(F.sequence(F.when(inside, n_in).otherwise(0), n_in + n_out - 1))
    brief = classes.select("class", "n_shingles", "signature", F.transform("bands", lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")).alias("tags"))
    spread = (
        cut.select("bucket", "band", "class", "comp", block.alias("block"), others.alias("others")).join(brief, "class")
        .withColumn("other", F.explode("others"))
        .select("bucket", "band", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                "block", "comp", *brief.columns))
    task = ["bucket", "band", "lo", "hi"]
    hits = stored(spread.groupBy(*task).applyInArrow(_wanted(least, ratio), spread.schema))
    full = hits.join(_sets_of(keyed, classes, hits.select("class"), width), "class")
    rest = full.groupBy(*task).applyInArrow(_across(least, ratio, percent), "a binary, b binary")
    label = connect(links.union(rest))

    rows = keyed.select("doc_id", "row_id").join(named, "row_id")
    rows = rows.join(label.toDF("class", "root"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    rows = stored(rows.select("doc_id", "n_shingles", "root"))
    lowest = rows.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("lowest"))
    out = rows.join(lowest, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("lowest"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))
