"""A corpus pipeline over ``documents``: rules, near duplicates, personal data, mixing, tokens.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes
each result to the shared scratch folder and rereads it for the next stage.  All
but the last return the columns of ``documents``.

* ``quality_rules`` keeps what the base rule and the certified cutoffs keep.
* ``near_dedup`` keeps the smallest id of each group of five-word-shingle
  similarity 0.8 or more (texts without words are no one's duplicate and stay).
* ``pii`` replaces personal data and disclosing terms in the text.
* ``mix_sources`` repeats or leaves out documents so that sources meet their
  weights, dealt to shards and shuffled in them.  A document taken twice is two rows.
* ``encode_pieces`` returns doc_id, source, token ids and their counts.

Nulls and edges: null texts fail the base rule and go; a null id or source is a
value like any other; empty tables give empty results; columns beyond those of
``documents`` pass through up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagoon.llm import minhash, mixing, pieces, pii, quality
from lagoon.session import scratch_path
from lagoon.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    judged = quality.judged(docs, labels, row_key=True).where("kept").select(quality.ROW_KEY).distinct()
    return quality.with_row_key(docs).join(judged, quality.ROW_KEY, "left_semi").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = minhash.near_duplicates(docs, width=5).where("kept").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").select(*docs.columns)
    return named.unionByName(docs.where("doc_id IS NULL"))


def pii_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitised(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    whole = docs.select(F.struct(*docs.columns).alias("_doc"), "doc_id", "text", "source")
    slim = mixing.measured(whole).drop("text", "source")
    return mixing.shard_rows(mixing.mix(slim)).select("_doc.*")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encoded(docs, keep=("doc_id", "source"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("pii", pii_removal),
    ("mix_sources", mix_sources),
    ("encode_pieces", encode_pieces),
]

#: No SQL: cutoffs, hashed draws and Viterbi paths have none; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
