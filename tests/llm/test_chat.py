"""Conversations against the registered SQL: other roles, very long turns, empty tables, repeated rows, clashing columns."""

import duckdb
import pytest
from pyspark.sql import functions as F

from lagoon.llm import chat, queries

ROWS = "conv_id long, turn long, role string, text string, formatted string, record string, turns int, loss_spans int"


def _both(spark, folder, rows):
    spark.createDataFrame([(*r, "f", "r", 1, 2) for r in rows], ROWS).coalesce(1).write.parquet(f"{folder}/conversations.parquet")
    got = queries.op4_chat(spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
    want = con.execute(queries.ORACLES["op4_chat"])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    return sorted(map(tuple, got.select(*names).collect()), key=str), sorted(want.fetchall(), key=str)


def test_roles_stay_as_given_and_repeated_rows_count(spark, tmp_dir):
    rows = [(1, 0, "human", "hi <|end|>\n"), (1, 1, "gpt", "ho"), (1, 1, "gpt", "ho"), (2, 0, None, None), (2, 1, "assistant", ""),
            (3, 5, "assistant", "a\\.b</s>"), (3, 5, "assistant", "a\\.b</s>"), (4, 0, "bot", "x"), (4, 1, "model", "[/INST]é日")]
    got, want = _both(spark, tmp_dir, rows)
    assert got == want and len(got) == 5


def test_a_turn_of_21_million_characters(spark, tmp_dir):
    long = F.repeat(F.lit("abc<|\\ "), 3_000_000)
    base = spark.createDataFrame([(1, 0, "user"), (1, 1, "assistant")], "conv_id long, turn long, role string")
    rows = base.withColumn("text", F.when(F.col("turn") == 1, long).otherwise("q"))
    done = chat.formatted(chat.canonical(chat.as_records(rows)))
    text = F.col("formatted")
    row = done.select(F.size(chat.parse(text)).alias("n"), F.char_length(chat.loss_text(text, F.col("loss_spans"))).alias("loss"),
                      (F.sha2(chat.loss_text(text, F.col("loss_spans")), 256) == F.sha2(long, 256)).alias("same")).first()
    assert (row.n, row.loss, row.same) == (2, 21_000_000, True)


def test_an_empty_table_leaves_the_added_conversation(spark, tmp_dir):
    got, want = _both(spark, tmp_dir, [])
    assert got == want and len(got) == 1


@pytest.mark.parametrize("kind", ["json", "struct"])
def test_structs_and_json_have_one_fingerprint(spark, kind):
    df = spark.createDataFrame([(1,)], "i int").select(F.struct(
        F.array(F.struct(F.lit("human").alias("from"), F.lit("h").alias("value"))).alias("conversations"), F.lit(3).alias("id")).alias("record"))
    if kind == "json":
        df = df.withColumn("record", F.to_json("record"))
    row = chat.canonical(df).first()
    assert [(t.role, t.text) for t in row.turns] == [("user", "h")]
    assert row.fingerprint == spark.range(1).select(F.xxhash64(F.lit("conversations[].from\nconversations[].value\nid"))).first()[0]
