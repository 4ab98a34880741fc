"""Phrases of two to five words that stand together, by Toivonen's sampling method.

A phrase is frequent if it occurs at least ``min_count`` times in its language.

* **Sample.** One document in ``sample_every`` (by a hash of its row) is mined level by
  level with a lowered threshold; what is frequent there is the proposal ``S``.
* **Full pass.** Over all texts every word is counted, and every phrase whose first part
  (all but the last word) and rest (all but the first) are both in ``S``.  These are
  exactly the phrases of ``S`` and its negative border, the phrases just outside it.  Border
  phrases, nearly all rare, are summed under a hash of ``HASH_BITS`` bits: a sum below
  ``min_count`` proves every phrase under it infrequent, the others are failures.
* **Expansion.** If words or border phrases fail, a further pass counts the border phrases with
  failed hashes, and every phrase not counted so far whose shorter parts are all frequent,
  failures or not counted either.  Whatever frequent phrase is still missing holds a failure
  and passes this test, so one such pass closes the set: all frequent phrases are known
  with exact counts, whatever the sample was.

Tasks get ``S`` as a bitmap of ``FILTER_BITS`` hashed positions, so what is broadcast has a
fixed size.  A false hit only means that a phrase is counted that need not be; a crowded
bitmap means more counting, never a wrong count.  Counts are summed per chunk of text
inside tasks, keyed by the words themselves, then by Spark.

Edges: null texts count as empty, a null language as ``und``; null and repeated ids are
documents of their own; ties go by phrase (UTF-8 order); an empty table gives no rows;
further columns are ignored.  A text of any length is read whole.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagoon.llm import textbatch as tb
from lagoon.llm.tables import stored
from lagoon.session import scratch_path

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
SAMPLE_EVERY = 16
FILTER_BITS = 1 << 26
HASH_BITS = 40
_BUCKET = 32_768  # bits of one piece of a bitmap, as Spark's bitmap functions have it
_SALTS = 64

_KIND = np.zeros(256, np.uint8)  # 0 word, 1 blank, 2 mark that ends a piece
_KIND[[9, 32]] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_SPACE = pa.scalar(" ", pa.large_string())
_LINE = pa.scalar("\n", pa.large_string())
_STEP = np.uint64(0x9DDFEA08EB382D69)


# ---------------------------------------------------------------- inside tasks


class Words:
    """The words of a chunk: a code per word (by language and word), its piece, and per code its text and hash."""

    def __init__(self, part: pa.RecordBatch) -> None:
        data, offsets = tb.utf8(part.column("text"))
        data = tb.lower_ascii(data)
        kind = _KIND[data]
        solid = kind == 0
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        first = solid.copy()
        first[1:] &= ~solid[:-1] | edge[1:-1]
        last = solid.copy()
        last[:-1] &= ~solid[1:] | edge[1:-1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        doc = np.searchsorted(offsets, starts, side="right") - 1
        self.piece = np.cumsum(kind == 2)[starts] + doc if len(starts) else np.zeros(0, np.int64)
        sizes = np.append(0, np.cumsum(ends - starts)).astype(np.int64)
        letters = data[solid]
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(sizes), pa.py_buffer(letters)).dictionary_encode()
        langs = part.column("lang").dictionary_encode()
        n_langs = max(1, len(langs.dictionary))
        both = words.indices.to_numpy(zero_copy_only=False).astype(np.int64) * n_langs + langs.indices.to_numpy(zero_copy_only=False)[doc]
        known, code, count = np.unique(both, return_inverse=True, return_counts=True)
        turn = np.argsort(pc.binary_length(words.dictionary).to_numpy(zero_copy_only=False)[known // n_langs], kind="stable")  # codes rise with length
        place = np.empty(len(turn), np.int64)
        place[turn] = np.arange(len(turn))
        known, self.code, self.count = known[turn], place[code], count[turn]
        self.text = words.dictionary.take(pa.array(known // n_langs))
        self.lang = langs.dictionary.take(pa.array(known % n_langs))
        self.hash = _hashes(self.lang, self.text)


def _hashes(lang: pa.Array, text: pa.Array) -> np.ndarray:
    out = []
    for column in (lang, text):
        data, offsets = tb.utf8(column)
        out.append(tb.span_hashes(tb.prefix_hashes(data), offsets[:-1], offsets[1:]))
    return tb.mix64(out[0] * _STEP + out[1])


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return tb.mix64(left * _STEP + right)


def _has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _counted(words: Words, known: np.ndarray, before: np.ndarray | None, hot: np.ndarray | None, hashed: bool) -> Iterator[pa.RecordBatch]:
    """``key, h, f`` of one chunk: phrases with both parts in ``known``, unless both are in ``before``.

    A key is a language, a line end and a phrase; without ``before`` there are the words and, as
    empty phrases, the number of words of a language.  With ``hashed``, phrases outside ``known``
    have a hash for a key.  With ``hot``, phrases that were counted by such a hash are counted
    if the hash is hot, and these and all that ``before`` did not count may be parts of longer ones.
    """
    def batch(lang: pa.Array, text: pa.Array, f: np.ndarray) -> pa.RecordBatch:
        keys = pc.binary_join_element_wise(lang.cast(pa.large_string()), text, _LINE)
        return pa.RecordBatch.from_arrays([keys.cast(pa.string()), pa.nulls(len(f), pa.int64()), pa.array(f, pa.int64())], names=["key", "h", "f"])

    code, piece = words.code, words.piece
    if before is None:
        yield batch(words.lang, words.text, words.count)
        langs = words.lang.dictionary_encode()
        n = np.bincount(langs.indices.to_numpy(), weights=words.count, minlength=len(langs.dictionary)).astype(np.int64)
        yield batch(langs.dictionary, pa.array([""] * len(n), pa.large_string()), n)
    own = words.hash[code]
    # Of the phrases of k - 1 words that start at each word: hash, whether known now and before, a code of the chunk.
    hashes, inside = own, _has(known, words.hash)[code]
    old = np.zeros(len(code), dtype=bool) if before is None else _has(before, words.hash)[code]
    codes, text = code.astype(np.int64), words.text
    for k in range(2, LONGEST + 1):
        n = len(code) - k + 1
        if n <= 0:
            return
        at = np.flatnonzero(inside[:n] & inside[1:n + 1] & (piece[:n] == piece[k - 1:]))
        key = (codes[at] << 32) | code[at + k - 1]
        h = _joined(hashes[at], own[at + k - 1])
        seen = old[at] & old[at + 1]
        hit = _has(known, h)
        was = seen & _has(before, h) if before is not None else seen
        count = ~seen
        if hashed:
            count = hit
            sums, f = np.unique(h[~hit] >> np.uint64(64 - HASH_BITS), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(f), pa.string()), pa.array(sums.astype(np.int64)), pa.array(f, pa.int64())], names=["key", "h", "f"])
        elif hot is not None:
            count = ~seen | (~was & _has(hot, h >> np.uint64(64 - HASH_BITS)))
            hit = np.where(was, hit, count)
        new, f = np.unique(key[count], return_counts=True)
        if len(new):
            head, tail = pa.array(new >> 32), pa.array(new & 0xFFFFFFFF)
            yield batch(words.lang.take(tail), pc.binary_join_element_wise(text.take(head), words.text.take(tail), _SPACE), f)
        at, h, was, key = at[hit], h[hit], was[hit], key[hit]
        hashes, inside, old = np.zeros(len(code), np.uint64), np.zeros(len(code), dtype=bool), np.zeros(len(code), dtype=bool)
        hashes[at], inside[at], old[at] = h, True, was
        unique, place = np.unique(key, return_inverse=True)
        codes = np.zeros(len(code), np.int64)
        codes[at] = place
        text = pc.binary_join_element_wise(text.take(pa.array(unique >> 32)), words.text.take(pa.array(unique & 0xFFFFFFFF)), _SPACE)


def _pass(known, before, hot, hashed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = [np.frombuffer(b.value, np.uint8) if b is not None else None for b in (known, before, hot)]
        for whole in batches:
            for part in tb.chunks(whole, "text", 4 * tb.CHUNK_BYTES):
                yield from _counted(Words(part), *bitmaps, hashed)
    return run


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bitmap positions of phrases."""
    for part in batches:
        lang, words = part.column("lang"), pc.split_pattern(part.column("phrase"), " ")
        size = np.diff(words.offsets.to_numpy())
        flat = words.flatten()
        row = np.repeat(np.arange(part.num_rows), size)
        word_hash = _hashes(lang.take(pa.array(row)), flat)
        start = np.cumsum(size) - size
        h = word_hash[start]
        for k in range(1, int(size.max(initial=1))):
            more = np.flatnonzero(size > k)
            h[more] = _joined(h[more], word_hash[start[more] + k])
        at = (h & np.uint64(FILTER_BITS - 1)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(at // _BUCKET), pa.array(at % _BUCKET)], names=["bucket", "place"])


# ---------------------------------------------------------------- passes


def bitmap(phrases: DataFrame) -> bytes:
    """The bitmap of a table of phrases: at most ``FILTER_BITS`` bits, whatever the table's size."""
    return _bits(phrases.select("lang", "phrase").mapInArrow(_places, "bucket long, place long"))


def _hot_bitmap(hashes: DataFrame) -> bytes:
    at = F.pmod("h", F.lit(FILTER_BITS))
    return _bits(hashes.select(F.floor(at / _BUCKET).alias("bucket"), (at % _BUCKET).alias("place")))


def _bits(places: DataFrame) -> bytes:
    out, size = bytearray(FILTER_BITS // 8), _BUCKET // 8
    pieces = places.groupBy("bucket").agg(F.expr("bitmap_construct_agg(place)").alias("bits"))
    for r in pieces.collect():  # at most FILTER_BITS / _BUCKET pieces
        out[r["bucket"] * size:(r["bucket"] + 1) * size] = r["bits"]
    return bytes(out)


def _counts(texts: DataFrame, threshold: int, known, before=None, hot=None, hashed: bool = False) -> DataFrame:
    """``lang, words, phrase, h, f`` of what a pass counts and finds often enough; languages under an empty phrase."""
    sums = texts.mapInArrow(_pass(known, before, hot, hashed), "key string, h long, f long").groupBy("key", "h").agg(F.sum("f").alias("f"))
    phrase = F.substring_index("key", "\n", -1)
    return sums.where((F.col("f") >= threshold) | F.col("key").endswith("\n")).select(
        F.expr("substring(key, 1, char_length(key) - char_length(substring_index(key, '\\n', -1)) - 1)").alias("lang"),
        F.when(phrase == "", 0).otherwise(F.size(F.split(phrase, " "))).alias("words"), phrase.alias("phrase"), "h", "f")


def proposed(sample: DataFrame, threshold: int) -> DataFrame:
    """All phrases that occur ``threshold`` times in a sample (``lang, text``), level by level."""
    spark = sample.sparkSession
    share = spark.sparkContext.broadcast
    known, before, levels = share(bytes(FILTER_BITS // 8)), None, []
    for _ in range(LONGEST):
        found = stored(_counts(sample, threshold, known, before).where("words > 0").drop("h"))
        levels.append(found)
        before, known = known, share(_union(known.value, bitmap(found)))
    return stored(functools.reduce(DataFrame.unionByName, levels))


def verified(texts: DataFrame, proposal: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """All phrases that occur ``threshold`` times in ``texts`` (``lang, text``), and the words per language."""
    share = texts.sparkSession.sparkContext.broadcast
    before = share(bitmap(proposal))
    found = stored(_counts(texts, threshold, before, hashed=True))
    totals = found.where("words = 0").select("lang", F.col("f").alias("n"))
    frequent = found.where("words > 0").drop("h")
    hot = found.where("h IS NOT NULL")
    failures = frequent.where("words = 1").join(proposal.select("lang", "phrase"), ["lang", "phrase"], "left_anti")
    if hot.limit(1).count() or failures.limit(1).count():
        more = _counts(texts, threshold, share(bitmap(frequent)), before, share(_hot_bitmap(hot)))
        frequent = stored(frequent.unionByName(more.drop("h")))
    return frequent, totals


def _union(a: bytes, b: bytes) -> bytes:
    return (np.frombuffer(a, np.uint8) | np.frombuffer(b, np.uint8)).tobytes()


def sample_threshold(min_count: int, every: int) -> int:
    """A standard deviation below the expected count of a phrase that just reaches ``min_count``.

    Lower would propose more, and with it make a wider border to count; what is missed is found as a failure.
    """
    mean = min_count / every
    return max(1, math.ceil(mean - math.sqrt(mean)))


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, sample_every: int = SAMPLE_EVERY) -> tuple[DataFrame, DataFrame]:
    """``lang, words, phrase, f`` of all phrases of 1 to ``LONGEST`` words with f >= ``min_count``, and ``lang, n``."""
    tb.small_batches(docs.sparkSession)
    said = (F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    drawn = F.pmod(F.xxhash64(F.lit(13), "doc_id", "text"), F.lit(sample_every)) == 0
    path = scratch_path(docs.sparkSession, "phrases-sample")
    docs.where(drawn).select(*said).write.parquet(path)
    sample, texts = docs.sparkSession.read.parquet(path), docs.select(*said)
    return verified(texts, proposed(sample, sample_threshold(min_count, sample_every)), min_count)


# ---------------------------------------------------------------- scores


def _cut(k: Column) -> list[Column]:
    words = F.split("phrase", " ")
    return [F.array_join(F.slice(words, F.lit(1), k), " "), F.array_join(F.slice(words, k + 1, F.size(words) - k), " ")]


def exact_score() -> Column:
    """floor(1000 a n / (l r)) of columns ``a, n, l, r``, in decimals of 38 digits."""
    return F.expr("CAST((CAST(1000 AS DECIMAL(4,0)) * (CAST(a AS DECIMAL(17,0)) * CAST(n AS DECIMAL(17,0))))"
                  " DIV (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0))) AS BIGINT)")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, sample_every: int = SAMPLE_EVERY) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's first ``top`` phrases.

    The score of a cut is floor(1000 a n / (l r)) in exact decimals; the lowest cut counts.
    A phrase goes if a longer one that holds it occurs as often; as counts never grow with
    length, it is enough to look one word further.
    """
    frequent, totals = frequent_phrases(docs, min_count, sample_every)
    longer = frequent.where("words > 2").select("lang", "f", F.col("words"), F.split("phrase", " ").alias("w"))
    ends = F.array(F.array_join(F.slice("w", F.lit(1), F.col("words") - 1), " "), F.array_join(F.slice("w", F.lit(2), F.col("words") - 1), " "))
    inside = longer.select("lang", F.explode(ends).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    kept = (frequent.where("words > 1").join(inside, ["lang", "phrase"], "left")
            .where("most IS NULL OR 100 * most < 100 * f").select("lang", "phrase", "words", F.col("f").alias("a")))
    cuts = kept.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    first, rest = _cut(F.col("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", first.alias("first"), rest.alias("rest"))
    left = frequent.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    priced = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(F.broadcast(totals), "lang")
    best = (priced.withColumn("score", exact_score()).groupBy("lang", "phrase", "a", "n")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))).orderBy(*order)
    near = best.withColumn("_n", F.row_number().over(part)).where(F.col("_n") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
