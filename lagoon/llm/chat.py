"""Chat formatting: schema fingerprints choose declarative mappings to canonical turns.

A record is JSON or a struct in any of the layouts below.  Its *fingerprint* is a hash of
its sorted nested field paths (array steps are ``[]``), so records of one layout
share a fingerprint whatever their values are.  The paths of a struct come from its type;
its texts are read as they are, of any length (a JSON parser refuses strings of over
20 million characters, and such a JSON record counts as malformed).  Roles stay as they
are said, but for the layout whose speakers have other names (``NAMES``).  ``LAYOUTS`` lists, per set of
paths, where turns come from: a list of messages, or single fields with a fixed
role.  Rows are matched by fingerprint (a CASE over the few known hashes), not
by trying parsers; unknown layouts give null turns and are returned with their
fingerprint, so that a mapping can be added.

The template is ``<|role|>\\n text <|end|>\\n`` per turn.  Control strings inside
roles and texts (``CONTROL``) are broken by ``\\.`` after their first character
and each backslash is doubled, so a formatted text is parsed back exactly
(``parse``).  Loss spans are [start, end) code points of assistant texts.

Nulls and edges: null text or role is empty; turns sort by (turn, role, text),
null turns first; a record without turns formats to an empty string with no
spans; a null or malformed record has a null fingerprint and null turns; turns
of a null conversation id form one conversation; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEARN_ROLE = "assistant"

#: Control strings of common chat templates that texts must not contain unescaped.
CONTROL = ["<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]"]

#: (field paths that decide, how to read turns): ("list", field, role key, text key) or ("fields", [(role, field)]).
LAYOUTS: list[tuple[tuple[str, ...], tuple]] = [
    (("messages[].content", "messages[].role"), ("list", "messages", "role", "content")),
    (("messages[].role", "messages[].text"), ("list", "messages", "role", "text")),
    (("conversations[].from", "conversations[].value"), ("list", "conversations", "from", "value")),
    (("prompt", "response"), ("fields", [("user", "prompt"), (LEARN_ROLE, "response")])),
    (("completion", "prompt"), ("fields", [("user", "prompt"), (LEARN_ROLE, "completion")])),
    (("instruction", "output"), ("fields", [("user", "instruction"), (LEARN_ROLE, "output")])),
    (("input", "instruction", "output"),
     ("fields", [("user", "instruction"), ("user", "input"), (LEARN_ROLE, "output")])),
    (("answer", "question"), ("fields", [("user", "question"), (LEARN_ROLE, "answer")])),
    (("answer", "question", "system"), ("fields", [("system", "system"), ("user", "question"), (LEARN_ROLE, "answer")])),
]
#: By the field of a layout: other names of the canonical roles.
NAMES = {"conversations": {"human": "user", "gpt": LEARN_ROLE, "bot": LEARN_ROLE, "model": LEARN_ROLE, "prompter": "user"}}

_TURN = "struct<role:string,text:string>"


def field_paths(record: Column) -> Column:
    """Sorted field paths of a JSON object: ``key``, ``key.field`` or ``key[].field``; null for anything else.

    Kinds come from the parsed values (variants), so a text that looks like JSON stays a text.
    """
    def below(entry: Column) -> Column:
        kind = F.schema_of_variant(entry["value"])
        step = F.when(kind.startswith("ARRAY<OBJECT<"), "[].").when(kind.startswith("OBJECT<"), ".")
        names = F.regexp_extract_all(kind, F.lit("[<,] ?([^<>:,]+): "), F.lit(1))
        return F.when(step.isNull() | (F.size(names) == 0), F.array(entry["key"])).otherwise(
            F.transform(names, lambda name: F.concat(entry["key"], step, name)))

    entries = F.map_entries(F.from_json(record, "map<string,variant>"))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(entries, below))))


def struct_paths(kind: T.StructType) -> list[str]:
    """The same field paths, from the type of a struct."""
    out = []
    for f in kind.fields:
        step, inner = ("[].", f.dataType.elementType) if isinstance(f.dataType, T.ArrayType) else (".", f.dataType)
        out += [f.name + step + x for x in inner.names] if isinstance(inner, T.StructType) and inner.names else [f.name]
    return sorted(set(out))


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def _turns(record: Column, how: tuple, is_json: bool) -> Column:
    def field(kind: str) -> Column:
        return F.from_json(record, f"struct<{kind}>") if is_json else record

    if how[0] == "list":
        _, name, role, text = how
        said = field(f"`{name}`:array<struct<`{role}`:string,`{text}`:string>>")[name]
        names = NAMES.get(name)
        canon = F.create_map(*[F.lit(x) for kv in names.items() for x in kv]) if names else None
        return F.transform(said, lambda m: F.struct(
            F.coalesce(*([] if canon is None else [canon[m[role]]]), m[role], F.lit("")).alias("role"), F.coalesce(m[text], F.lit("")).alias("text")))
    parsed = field(",".join(f"`{f}`:string" for _, f in how[1]))
    return F.array(*[F.struct(F.lit(r).alias("role"), F.coalesce(parsed[f], F.lit("")).alias("text")) for r, f in how[1]])


def canonical(records: DataFrame, record_col: str = "record") -> DataFrame:
    """``records`` with ``fingerprint`` and ``turns`` (array of role, text)."""
    # Extra scalar fields don't change where the turns are: only paths that some layout names are hashed.
    known = sorted({p for paths, _ in LAYOUTS for p in paths})
    record, kind = F.col(record_col), records.schema[record_col].dataType
    is_json = not isinstance(kind, T.StructType)
    paths = field_paths(record) if is_json else F.when(record.isNotNull(), F.array(*[F.lit(p) for p in struct_paths(kind)]))
    out = records.withColumn("_paths", paths).withColumn(
        "fingerprint", F.when(F.col("_paths").isNotNull(), fingerprint(F.col("_paths"))))
    out = out.withColumn("_known", fingerprint(F.array_intersect("_paths", F.array(*[F.lit(p) for p in known]))))
    turns = F.lit(None).cast(f"array<{_TURN}>")
    for names, how in reversed(LAYOUTS):
        if is_json or set(names) <= set(struct_paths(kind)):
            chosen = F.col("_known") == fingerprint(F.array(*[F.lit(p) for p in sorted(names)]))
            turns = F.when(chosen, _turns(record, how, is_json)).otherwise(turns)
    return out.withColumn("turns", turns).drop("_paths", "_known")


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, r"([<\[])(?=\||s>|/s>|<SYS>>|</SYS>>|/?INST\])", r"$1\\.")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(?:(\\)|\.)", "$1")


def formatted(turns: DataFrame, turns_col: str = "turns") -> DataFrame:
    """``turns`` with ``formatted`` and ``loss_spans`` (array of start, end in code points)."""
    parts = F.transform(turns_col, lambda t: F.struct(
        F.concat(F.lit("<|"), F.replace(escape(t["role"]), F.lit("|>"), F.lit("|\\.>")), F.lit("|>\n")).alias("head"),
        escape(t["text"]).alias("body"), (t["role"] == LEARN_ROLE).alias("learn")))
    tail = "<|end|>\n"
    out = turns.withColumn("_parts", parts)
    spans = F.aggregate(
        "_parts", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda a, p: F.struct(
            (a["at"] + F.char_length(p["head"]) + F.char_length(p["body"]) + len(tail)).cast("long").alias("at"),
            F.when(p["learn"], F.concat(a["spans"], F.array(F.struct(
                (a["at"] + F.char_length(p["head"])).cast("long").alias("start"),
                (a["at"] + F.char_length(p["head"]) + F.char_length(p["body"])).cast("long").alias("end")))))
            .otherwise(a["spans"]).alias("spans")))["spans"]
    text = F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit(tail))), "")
    return out.withColumns({"formatted": text, "loss_spans": spans}).drop("_parts")


def parse(text: Column) -> Column:
    """The turns of a formatted text: array of role, text."""
    blocks = F.filter(F.split(text, r"<\|end\|>\n"), lambda b: b.startswith("<|"))
    return F.transform(blocks, lambda b: F.struct(
        unescape(F.regexp_extract(b, r"(?s)^<\|(.*?)\|>\n", 1)).alias("role"),
        unescape(F.regexp_replace(b, r"(?s)^<\|.*?\|>\n", "")).alias("text")))


def loss_text(text: Column, spans: Column) -> Column:
    """What the loss mask covers, unescaped and joined."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def as_records(conversations: DataFrame) -> DataFrame:
    """One record (a struct of messages) per conversation from rows (conv_id, turn, role, text)."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("all"))
    return grouped.select("conv_id", F.struct(F.transform("all", lambda t: F.struct(
        t["role"].alias("role"), t["text"].alias("content"))).alias("messages")).alias("record"))
