"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Targets: every source gets its weight's share of ``share`` times all words, at
most ``max_copies`` times its own size; what is above goes to the others by
weight until none is above (solved in one pass over the sorted source table).

Draws: the documents of a source fall by hash into about sqrt(n) blocks (64
documents or more each).  A target is whole passes over the source plus a rest.
Of the documents longer than ``LONG`` of the rest, their proportional share is drawn
first, in hashed order, the one that reaches it included if the rest holds it: so the
short ones always suffice for what is left.  They are drawn as blocks in a hashed
order; the block that crosses the target gives documents in hashed
order up to the first that does not fit.  If the gap left is above ``TOLERANCE`` of
the target (a long document crossed it), further rounds go on in the same order
over the documents not yet drawn that fit the gap, until the gap is within the
tolerance or no document fits.

Shards: the blocks so drawn are dealt to ``2 ** depth`` output shards, by default
one for ``SHARD_WORDS`` words of the mix (``least_depth`` at least).  One
row per tree node holds the quota of blocks per source; each level splits
every node in half, the left half's counts drawn from the multivariate
hypergeometric distribution (source by source, hypergeometric given what is
left).  Quotas are exact at every node.  The leaves' quotas then cut each
source's permuted blocks into disjoint runs, one per shard, and a shard is
shuffled locally (``shard_rows``, ``SHARD_PARTS`` tasks each).

Everything is keyed by hashes of the row, so reruns agree.  No task holds more
than about sqrt(n) blocks of a source, or one block; per-source and per-block
tables are broadcast only below a checked size.

Nulls and edges: a null text has size 0; null is a source of its own, last in
code-point order; documents of size 0 count as taken with 0 words; rows equal in
id, source and text are taken together; all sizes 0 gives targets of 0; an
empty table gives an empty mix; other columns of the input pass through, those
named like a result column (``RESULT``) are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagoon.llm.nativemath import WORD, hypergeometric, let
from lagoon.llm.tables import small, stored

RESULT = ("size", "source_size", "target", "taken", "copies", "shards")
LEAST_BLOCK = 64
LONG, TOLERANCE = 0.01, 0.005
SHARD_WORDS = 4_000_000
SHARD_PARTS = 4


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with ``size`` (words of the text) and the helper columns ``_source``, ``_key``."""
    return docs.withColumns({
        "size": F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long"),
        "_source": F.col(source_col).cast("string"),
        "_key": F.concat(*[F.hex(F.xxhash64(F.lit(k), F.col(id_col), F.col(source_col), F.col(text_col))) for k in (1, 2)]),
    })


def _targets(rows: DataFrame, weights: tuple[float, ...], share: float, max_copies: int) -> DataFrame:
    """One row per source: rank, source_size, n_docs, target."""
    sums = rows.groupBy("_source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    order = Window.orderBy(F.col("_source").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in weights])
    ranked = (sums.withColumn("_rank", F.row_number().over(order) - 1)
              .withColumn("w", w[(F.col("_rank") % len(weights)).cast("int")])
              .withColumn("cap", F.lit(float(max_copies)) * F.col("source_size"))
              .withColumn("level", F.col("cap") / F.col("w")))
    everything = Window.partitionBy(F.lit(1))
    upto = everything.orderBy("level", "_rank").rowsBetween(Window.unboundedPreceding, -1)
    onward = everything.orderBy("level", "_rank").rowsBetween(0, Window.unboundedFollowing)
    goal = F.lit(float(share)) * F.sum("source_size").over(everything)
    # The water level if every source before this one stops at its cap.
    ranked = ranked.withColumn("water", (goal - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))) / F.sum("w").over(onward))
    first = F.min(F.when(F.col("water") <= F.col("level"), F.struct("level", "_rank", "water"))).over(everything)
    return (ranked.withColumn("first", first)
            .withColumn("target", F.least("cap", F.coalesce(F.col("w") * F.col("first.water"), F.col("cap"))))
            .select("_source", "_rank", "source_size", "n_docs", "target"))


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash of the parts."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def split_quotas(counts: DataFrame, depth: int, seed: int) -> DataFrame:
    """Rows (shard, _rank, quota) from one row per source (_rank, units)."""
    root = counts.agg(F.array_sort(F.collect_list(F.struct("_rank", "units"))).alias("have"))
    tree = root.select(F.lit(0).cast("long").alias("node"),
                       F.transform("have", lambda x: x["_rank"].cast("long")).alias("ranks"),
                       F.transform("have", lambda x: x["units"].cast("long")).alias("counts"))
    for level in range(depth):
        total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
        seeded = F.transform("counts", lambda x, i: F.struct(
            x.alias("n"), _uniform(F.lit(seed), F.lit(level), F.col("node"), i).alias("u")))
        nothing = F.array().cast("array<bigint>")
        state = F.struct(total.alias("total"), F.floor(total / 2).cast("long").alias("draw"), nothing.alias("out"))

        def step(a: Column, x: Column) -> Column:
            return let(hypergeometric(a["total"], x["n"], a["draw"], x["u"]), lambda k: F.struct(
                (a["total"] - x["n"]).alias("total"), (a["draw"] - k).alias("draw"),
                F.concat(a["out"], F.array(k)).alias("out")))

        left = F.aggregate(seeded, state, step)["out"]
        halves = tree.withColumn("left", left).withColumn("right", F.zip_with("counts", "left", lambda n, k: n - k))
        tree = stored(halves.select("ranks", F.posexplode(F.array("left", "right")).alias("side", "counts"), "node")
                      .select((F.col("node") * 2 + F.col("side")).cast("long").alias("node"), "ranks", "counts"))
    pairs = tree.select(F.col("node").alias("shard"), F.explode(F.arrays_zip("ranks", "counts")).alias("p"))
    return pairs.select("shard", F.col("p.ranks").alias("_rank"), F.col("p.counts").alias("quota"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_copies: int = 2,
        depth: int | None = None, least_depth: int = 4, seed: int = 11) -> DataFrame:
    """``docs`` (see ``measured``) with ``source_size, target, taken, copies, shards`` per row.

    ``shards`` holds one output shard per copy of the row that the mix takes.
    """
    rows = stored(docs.select("_source", "_key", F.col("size").cast("long").alias("size")))
    targets = stored(_targets(rows, weights, share, max_copies))
    passes = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")),
                                                      F.lit(max_copies))).otherwise(0).cast("int")
    n_blocks = F.ceil(F.col("n_docs") / F.greatest(F.lit(float(LEAST_BLOCK)), F.sqrt("n_docs")))
    plan = targets.withColumns({"passes": passes, "n_blocks": n_blocks.cast("long")}).withColumn(
        "rest", F.when(F.col("passes") < max_copies, F.col("target") - F.col("passes") * F.col("source_size")).otherwise(0.0))
    plan = small(plan)

    def blocked(frame: DataFrame) -> DataFrame:
        joined = frame.join(plan.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
        return joined.withColumns({"_block": F.pmod(F.xxhash64(F.lit(seed), "_key"), F.col("n_blocks")),
                                   "_long": (F.col("rest") > 0) & (F.col("size") > LONG * F.col("rest"))})

    # Long documents first: at most 1 / LONG of a source are drawn.
    long = blocked(rows).where("_long")
    goals = long.groupBy("_rank").agg((F.sum("size") * F.first(F.col("rest") / F.col("source_size"))).alias("goal"))
    items = long.groupBy("_rank", "_block", "_key", F.col("rest").alias("gap")).agg(F.sum("size").alias("words"))
    chosen = stored(_first_fitting(items.join(small(stored(goals)), "_rank"), seed))
    got = small(stored(chosen.groupBy("_rank").agg(F.sum("words").alias("got"))))

    sums = blocked(rows).groupBy("_rank", "_block").agg(
        F.sum(F.when(~F.col("_long"), F.col("size")).otherwise(0)).alias("words"), F.first("rest").alias("rest"), F.first("passes").alias("passes"))
    sums = sums.join(got, "_rank", "left").withColumn("rest", F.col("rest") - F.coalesce("got", F.lit(0))).drop("got")
    order = Window.partitionBy("_rank").orderBy(F.xxhash64(F.lit(seed), "_rank", "_block"), "_block")
    upto = F.sum("words").over(order)
    blocks = (sums.withColumn("upto", upto)
              .withColumn("full", F.col("upto") <= F.col("rest"))
              .withColumn("gap", F.when(~F.col("full") & (F.col("upto") - F.col("words") < F.col("rest")),
                                        F.col("rest") - F.col("upto") + F.col("words"))))
    blocks = stored(blocks.select("_rank", "_block", "passes", "full", "gap", (F.col("rest") - F.col("upto")).alias("left")))

    # The gap of each source that full blocks leave; the first round looks at the short documents of its crossing block only;
    # where all short documents are drawn, at the long ones.
    gaps = blocks.groupBy("_rank").agg(F.coalesce(F.max("gap"), F.min("left")).alias("gap"),
                                       F.max(F.when(F.col("gap").isNotNull(), F.col("_block"))).alias("only")).where("gap > 0")
    full = small(stored(blocks.where("full").select("_rank", "_block", "full")))
    free = blocked(rows).where("size > 0").join(full, ["_rank", "_block"], "left").where("full IS NULL OR _long")
    while True:
        gaps = small(stored(gaps))
        items = free.join(gaps, "_rank").where("(only IS NULL AND size <= gap) OR (only = _block AND NOT _long)")
        items = items.join(small(chosen.select("_rank", "_key")), ["_rank", "_key"], "left_anti")
        items = items.groupBy("_rank", "_block", "_key", "gap", "only").agg(F.sum("size").alias("words"))
        items = items.where("words <= gap OR only IS NOT NULL").withColumn("goal", F.col("gap"))
        picked = stored(_first_fitting(items, seed))
        chosen = stored(chosen.unionByName(picked))
        left = gaps.join(picked.groupBy("_rank").agg(F.sum("words").alias("got")), "_rank", "left").join(
            targets.select("_rank", "target"), "_rank")
        left = left.withColumn("gap", F.col("gap") - F.coalesce("got", F.lit(0)))
        # A round without a pick was the last one, but for the first, which sees a block only.
        gaps = stored(left.where((F.col("gap") > TOLERANCE * F.col("target")) & (F.col("got").isNotNull() | F.col("only").isNotNull()))
                      .select("_rank", "gap", F.lit(None).cast("long").alias("only")))
        if gaps.isEmpty():
            break
    partial = small(stored(chosen.select("_rank", "_block").distinct().withColumn("partial", F.lit(True))))
    units = F.col("passes") + F.when(F.col("full") | F.col("partial"), 1).otherwise(0)
    blocks = stored(blocks.drop("left").join(partial, ["_rank", "_block"], "left").withColumn("units", units))
    chosen = small(stored(chosen.select("_rank", "_key", F.lit(True).alias("chosen"))))
    if depth is None:
        words = targets.agg(F.sum("target")).first()[0] or 0.0
        depth = max(least_depth, math.ceil(math.log2(max(1.0, words / SHARD_WORDS))))

    # Units (block, copy) in a permuted order, cut by the leaves' quotas.
    drawn = blocks.where("units > 0").select(
        "_rank", "_block", F.explode(F.sequence(F.lit(1), "units")).alias("copy"))
    turn = Window.partitionBy("_rank").orderBy("copy", F.xxhash64(F.lit(seed + 2), "_rank", "_block", "copy"), "_block")
    drawn = drawn.withColumn("unit", F.row_number().over(turn).cast("long") - 1)
    quotas = split_quotas(blocks.groupBy("_rank").agg(F.sum("units").alias("units")), depth, seed)
    before = F.sum("quota").over(Window.partitionBy("_rank").orderBy("shard"))
    runs = quotas.withColumn("upto", before).where("quota > 0").select(
        "_rank", "shard", F.explode(F.sequence(F.col("upto") - F.col("quota"), F.col("upto") - 1)).alias("unit"))
    dealt = (drawn.join(runs, ["_rank", "unit"]).groupBy("_rank", "_block").agg(
        F.array_sort(F.collect_list(F.struct("copy", "shard"))).alias("copies")))
    table = blocks.join(dealt, ["_rank", "_block"], "left").select(
        "_rank", "_block", "full", F.transform("copies", lambda c: c["shard"].cast("int")).alias("_shards"))
    table = small(stored(table))

    out = blocked(docs.drop(*[c for c in RESULT if c != "size"])).join(table, ["_rank", "_block"], "left").join(
        chosen, ["_rank", "_key"], "left")
    copies = F.col("passes") + F.when((F.col("full") & ~F.col("_long")) | F.col("chosen"), 1).otherwise(0)
    return out.withColumns({
        "copies": copies, "taken": (F.col("size") * copies).cast("long"),
        "shards": F.when(copies > 0, F.slice("_shards", F.lit(1), copies)).otherwise(F.array().cast("array<int>")),
    }).drop("_rank", "_block", "_key", "_source", "_shards", "n_docs", "passes", "n_blocks", "rest", "full", "chosen", "_long")


def _first_fitting(items: DataFrame, seed: int) -> DataFrame:
    """The documents (_rank, _block, _key, words) that reach ``goal`` within ``gap``, in the order of blocks, then hashed in the block.

    Whole blocks are decided on their sums; only the block that crosses the goal is ordered by document.
    """
    sums = items.groupBy("_rank", "_block").agg(F.sum("words").alias("sum"), F.first("goal").alias("goal"))
    order = Window.partitionBy("_rank").orderBy(F.xxhash64(F.lit(seed), "_rank", "_block"), "_block")
    sums = sums.withColumn("before", F.sum("sum").over(order) - F.col("sum")).where("before < goal").drop("goal")
    near = items.join(small(stored(sums)), ["_rank", "_block"])
    whole = near.where("before + sum <= goal")
    turn = Window.partitionBy("_rank", "_block").orderBy(F.xxhash64(F.lit(seed + 1), "_key"), "_key")
    crossing = near.where("before + sum > goal").withColumn("upto", F.col("before") + F.sum("words").over(turn))
    crossing = crossing.where("upto - words < goal AND upto <= gap")
    names = ["_rank", "_block", "_key", "words"]
    return whole.select(*names).unionByName(crossing.select(*names))


def shard_rows(mixed: DataFrame, id_col: str = "doc_id", seed: int = 12) -> DataFrame:
    """One row per taken copy, dealt to its shard's ``SHARD_PARTS`` partitions and shuffled there."""
    turn = F.xxhash64(F.lit(seed), "shard", id_col)
    copies = mixed.withColumn("shard", F.explode("shards")).withColumn("_part", F.pmod(turn, F.lit(SHARD_PARTS)))
    return copies.repartition("shard", "_part").sortWithinPartitions("shard", turn, id_col).drop("_part")
