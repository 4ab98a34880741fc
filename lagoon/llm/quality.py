"""Quality rules with risk-controlled thresholds.

Per text, exact base figures (see ``rule_figures``) and, from them, the rates
that the rules cut: symbols per character, repeated-word share, duplicate-line
share, mean word length from above and from below.

Cutoffs come from labelled holdouts.  For each stratum (language) and rule,
every cutoff of a fixed grid is tested on the documents labelled good that pass
the base rule: with n such documents of which k would be rejected, the cutoff is
certified when P(Binomial(n, ``risk``) <= k) is at most ``error / tests``.  That
is the exact (Clopper-Pearson) statement that the false rejection rate is below
``risk``, and Bonferroni's correction over all tests (rules x grid x strata) makes
all certified cutoffs hold at once with probability 1 - ``error``.  The grid does
not depend on the labels, so the labelled rows are a holdout for it.  Among the
certified cutoffs a rule takes the one that rejects most documents labelled bad,
at ``price`` rejected bad ones per rejected good one; without gain the rule is
off in that stratum, and with too few labels none can be certified.

Everything is DataFrame expressions; a text's words and windows stay arrays
inside its row, labels are joined after the figures are stored, and only the
grid's counts are shuffled.

Nulls and edges: a null or empty text has no words and fails the base rule
(n_words < 50); a null stratum is a stratum of its own; a holdout case is a distinct
text of a stratum, however many rows, ids or labels it has (copies are no independent
draws); where its labels disagree it counts for neither side; labels that are null
or without document don't count; an empty label table leaves the base rule alone.
Other columns of the input pass through; those named like a figure are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagoon.llm.nativemath import WORD, binomial_cdf, let
from lagoon.llm.tables import small, stored

FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LEAST_WORDS = 50
ROW_KEY, TEXT_KEY = "__row_key", "__text_key"
#: Rule -> grid of cutoffs; a document is rejected if its rate is above the cutoff.
GRID = {
    "symbol_rate": [0.002, 0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2],
    "repeat_rate": [0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4],
    "dup_line_rate": [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8],
    "long_words": [7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0],
    "short_words": [-4.5, -4.0, -3.5, -3.0, -2.5, -2.0],
}


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text, exactly at any length.

    Window hashes are sorted with their position in the low bits, so equal
    windows become neighbours: n log n for a text of n words, no pairs.  Hash bits
    get fewer as texts grow, so the windows found this way are only candidates
    (all true ones are among them); their own words are then sorted and compared.
    """
    n = F.size(words) - 2
    bits = F.ceil(F.log2(n.cast("double") + 1)).cast("int")

    def packed(b: Column) -> Column:
        return F.sort_array(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.expr("0L").bitwiseOR(
            _shifted(F.xxhash64(words[i], words[i + 1], words[i + 2]), b)).bitwiseOR(i.cast("long"))))

    def candidates(keys: Column) -> Column:
        mask = _shifted(F.lit(-1).cast("long"), bits).bitwiseXOR(F.lit(-1).cast("long"))
        return F.transform(_twice(keys, n, lambda x: _high(x, bits)), lambda x: x.bitwiseAND(mask).cast("int"))

    def windows(at: Column) -> Column:
        return F.sort_array(F.transform(at, lambda i: F.struct(
            F.struct(*[F.get(words, i + k).alias(f"w{k}") for k in range(3)]).alias("w"), i.alias("at"))))

    def covered(found: Column) -> Column:
        at = F.sort_array(F.transform(_twice(found, F.size(found), lambda x: x["w"]), lambda x: x["at"].cast("long")))
        start = F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(at, start, lambda a, p: F.struct(
            p.alias("last"), (a["n"] + F.least(F.lit(3).cast("long"), p - a["last"])).alias("n")))["n"]

    return F.when(n < 2, F.lit(0).cast("long")).otherwise(
        let(packed(bits), lambda keys: let(windows(candidates(keys)), covered)))


def _twice(keys: Column, n: Column, part: Callable[[Column], Column]) -> Column:
    """Elements of a sorted array of ``n`` whose ``part`` equals a neighbour's."""
    return F.filter(keys, lambda x, i: ((i > 0) & (part(x) == part(F.get(keys, i - 1)))) | (
        (i < n - 1) & (part(x) == part(F.get(keys, i + 1)))))


def _high(x: Column, bits: Column) -> Column:
    return F.call_function("shiftrightunsigned", x, bits)


def _shifted(x: Column, bits: Column) -> Column:
    """``x`` with its low bits cleared."""
    return F.call_function("shiftleft", _high(x, bits), bits)


def rule_figures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the base figures (long), ``base_failed`` and the rule rates."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.char_length(w)).alias("word_chars"),
            _repeat_words(words).alias("n_repeat_words"))

    symbols = F.octet_length(text) - F.octet_length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))
    parts = docs.withColumns({
        "_w": let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), of_words),
        "n_symbols": symbols.cast("long"),
        "_l": let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                            F.size(F.array_distinct(x)).cast("long").alias("d"))),
    })
    figures = parts.withColumns({
        "n_words": F.col("_w.n_words"), "word_chars": F.col("_w.word_chars"),
        "n_dup_lines": F.col("_l.n") - F.col("_l.d"), "n_repeat_words": F.col("_w.n_repeat_words"),
        "_lines": F.col("_l.n"),
    }).drop("_w", "_l")
    n = F.greatest(F.col("n_words"), F.lit(1))
    mean = F.col("word_chars") / n
    return figures.withColumns({
        "base_failed": (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "symbol_rate": F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
        "repeat_rate": F.col("n_repeat_words") / n,
        "dup_line_rate": F.col("n_dup_lines") / F.greatest(F.col("_lines"), F.lit(1)),
        "long_words": mean, "short_words": -mean,
    }).drop("_lines")


def certified_cutoffs(figures: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.03,
                      error: float = 0.05, price: float = 25.0) -> DataFrame:
    """Rows (stratum, rule, cutoff, n_good, false_rejections, bound, bad_rejected), one per rule that is on.

    ``figures`` has ``doc_id``, the stratum, the rates and ``TEXT_KEY`` (without it, every id is a text of its own);
    ``labels`` has ``doc_id`` and ``quality`` (1 good, 0 bad).
    """
    ends = [F.min("least").alias("least"), F.max("most").alias("most")]
    said = (labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
            .agg(F.min("quality").alias("least"), F.max("quality").alias("most")))
    text = TEXT_KEY if TEXT_KEY in figures.columns else "doc_id"
    known = (figures.where("NOT base_failed").join(said, "doc_id").groupBy(stratum, text)
             .agg(*ends, *[F.first(r).alias(r) for r in GRID])
             .where("least = most").withColumnRenamed("least", "quality"))
    grid = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(float(c)).alias("cutoff"))
                     for r, cs in GRID.items() for c in cs])
    rate = F.coalesce(*[F.when(F.col("g.rule") == r, F.col(r)) for r in GRID])
    counted = (known.withColumn("g", F.explode(grid)).withColumn("hit", rate > F.col("g.cutoff"))
               .groupBy(F.col(stratum).alias("stratum"), F.col("g.rule").alias("rule"), F.col("g.cutoff").alias("cutoff"))
               .agg(F.count_if(F.col("quality") == 1).alias("n_good"),
                    F.count_if((F.col("quality") == 1) & F.col("hit")).alias("false_rejections"),
                    F.count_if((F.col("quality") == 0) & F.col("hit")).alias("bad_rejected")))
    counted = stored(counted)
    tests = max(1, counted.count())
    bound = binomial_cdf(F.col("false_rejections"), F.col("n_good"), risk)
    gain = F.col("bad_rejected") - F.lit(price) * F.col("false_rejections")
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc("gain"), F.desc("cutoff"))
    return (counted.where("n_good > 0").withColumn("bound", bound).withColumn("gain", gain)
            .where((F.col("bound") <= error / tests) & (F.col("gain") > 0))
            .withColumn("place", F.row_number().over(best)).where("place = 1").drop("place", "gain"))


def apply_rules(figures: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``figures`` with ``rejected_by`` (rules whose cutoff is passed) and ``kept``."""
    by_stratum = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cut"))
    by_stratum = small(stored(by_stratum))
    joined = figures.join(by_stratum, F.col(stratum).eqNullSafe(F.col("stratum")), "left").drop("stratum")
    hits = F.array_compact(F.array(*[F.when(F.col(r) > F.col("_cut")[r], F.lit(r)) for r in GRID]))
    return joined.withColumn("rejected_by", hits).drop("_cut").withColumn(
        "kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))


def with_row_key(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ROW_KEY``, 128 bits of id and text (equal rows are judged alike)."""
    return docs.withColumn(ROW_KEY, F.concat(*[F.hex(F.xxhash64(F.lit(seed), "doc_id", text_col)) for seed in (1, 2)]))


def judged(docs: DataFrame, labels: DataFrame, text_col: str = "text", stratum: str = "lang", row_key: bool = False,
           **settings) -> DataFrame:
    """``doc_id``, stratum, figures, ``rejected_by`` and ``kept`` per row of ``docs``; figures are computed once."""
    names = ["doc_id", stratum, *FIGURES, "base_failed", *GRID, TEXT_KEY, *([ROW_KEY] if row_key else [])]
    read = docs.select("doc_id", stratum, text_col)
    keyed = with_row_key(read, text_col) if row_key else read
    keyed = keyed.withColumn(TEXT_KEY, F.unhex(F.md5(text_col)))
    figures = stored(rule_figures(keyed, text_col).select(*names))
    return apply_rules(figures, certified_cutoffs(figures, labels, stratum, **settings), stratum).drop(TEXT_KEY)
