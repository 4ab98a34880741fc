"""Personal data: base patterns, and terms that give protected entities away.

Base spans (email, ip, card, phone) are found by fixed patterns with their
checks.  Each distinct value of a base span is a *protected entity*.  For terms
(words of ``TERM_LETTERS`` letters or more, lower case) near an entity -- the
``WINDOW`` terms on either side within its line -- the corpus gives

* how many texts hold the term anywhere, n(t),
* in how many texts it stands near the entity, n(e, t), counting texts with the
  same surroundings once,
* the disclosure log2(N * n(e, t) / (n(e) * n(t))) in bits, n(e) being the texts
  that hold the entity and N all texts.

A term is disclosing when some entity has n(e, t) >= ``SUPPORT`` in different
surroundings, P(e | t) >= ``SHARE`` and at least ``BITS`` bits; its occurrences
everywhere become spans of kind ``term`` unless a base span covers them.
``sanitised`` replaces base spans by their kind and terms by ``[TERM]``.

All counts cover all texts: a batch sends one row per distinct term, summed
before the shuffle.  Only terms that stand near an entity are joined with these
counts.  Flagged terms are sent to the texts in blocks of ``TERM_BLOCK`` hashes,
one pass over the texts per block, so a broadcast has a fixed bound and any
number of terms is handled.

Nulls and edges: a null text is empty (no spans); a null id is a row like any
other; spans are in code points, end exclusive; repeated rows get equal spans;
an empty table gives an empty result; other columns pass through ``sanitised``,
and are not read by ``found``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagoon.llm import textbatch as tb
from lagoon.llm.tables import stored

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
WINDOW, TERM_LETTERS, SUPPORT, SHARE, BITS = 4, 5, 3, 0.9, 8.0
TERM_BLOCK = 500_000

#: The base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TERM = re.compile(r"[^\W\d_]{%d,}" % TERM_LETTERS)
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain, found from each ``@`` outwards (linear in the text)."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            yield start, done
            at = text.find("@", done)
        else:
            done = max(done, at + 1)
            at = text.find("@", at + 1)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _part_fits(part: str) -> bool:
    short = part.lstrip("0")
    return len(short) < 3 or (len(short) == 3 and short <= "255")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind index, start, end), by kind and start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(map(_part_fits, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return out


def term_hash(term: str) -> int:
    return xxhash.xxh3_64_intdigest(term) - (1 << 63)


def near_terms(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[str, list[str]]]:
    """Per base span: its value and the terms around it in its line, spans left out."""
    covered = sorted((a, b) for _, a, b in spans)
    for kind, a, b in spans:
        line_start, line_end = text.rfind("\n", 0, a) + 1, text.find("\n", b)
        left = text[max(line_start, a - 40 * WINDOW):a]
        right = text[b:min(line_end if line_end >= 0 else len(text), b + 40 * WINDOW)]
        base = a - len(left)
        before = [m[0].lower() for m in _TERM.finditer(left) if not _inside(covered, base + m.start())][-WINDOW:]
        after = [m[0].lower() for m in _TERM.finditer(right) if not _inside(covered, b + m.start())][:WINDOW]
        yield f"{KINDS[kind]}:{text[a:b]}", before + after


def _inside(covered: list[tuple[int, int]], at: int) -> bool:
    return any(a <= at < b for a, b in covered)


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (entity, term, around) near base spans, (entity, null, null) per text with the entity, (null, term, n) counts."""
    names = ["entity", "term", "around", "n"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    for batch in batches:
        count: Counter[str] = Counter()
        entity, term, around, n = [], [], [], []
        for text in batch.column("text").to_pylist():
            text = text or ""
            count.update(set(map(str.lower, _TERM.findall(text))))
            spans = base_spans(text)
            seen = set()
            for value, terms in near_terms(text, spans):
                e, where = term_hash(value), term_hash(" ".join(terms))
                seen.add(e)
                for t in set(terms):
                    entity.append(e)
                    term.append(term_hash(t))
                    around.append(where)
                    n.append(1)
            for e in seen:
                entity.append(e)
                term.append(None)
                around.append(None)
                n.append(1)
        entity += [None] * len(count)
        term += map(term_hash, count)
        around += [None] * len(count)
        n += count.values()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((entity, term, around, n), types, strict=True)],
                                         names=names)


def disclosing_terms(docs: DataFrame, text_col: str = "text", support: int = SUPPORT, share: float = SHARE,
                     bits: float = BITS) -> DataFrame:
    """Rows (term hash, entity hash, bits) of the terms that give an entity away."""
    texts = docs.select(F.col(text_col).alias("text"))
    rows = texts.mapInArrow(_evidence, "entity long, term long, around long, n long")
    summed = stored(rows.groupBy("entity", "term", "around").agg(F.sum("n").alias("n")))
    pairs = (summed.where("entity IS NOT NULL AND term IS NOT NULL").groupBy("entity", "term")
             .agg(F.count("*").alias("places"), F.sum("n").alias("together")).where(F.col("places") >= support))
    entities = summed.where("term IS NULL").select("entity", F.col("n").alias("n_entity"))
    terms = summed.where("entity IS NULL").select("term", F.col("n").alias("n_term"))
    whole = texts.count()
    scored = (pairs.join(entities, "entity").join(terms, "term")
              .withColumn("together", F.least("together", "n_term", "n_entity"))
              .withColumn("bits", F.log2(F.lit(float(whole)) * F.col("together") / (F.col("n_entity") * F.col("n_term")))))
    return scored.where((F.col("together") >= share * F.col("n_term")) & (F.col("bits") >= bits)).select("term", "entity", "bits")


def _find(flagged):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = flagged.value
        for batch in batches:
            base, term = [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text or "")
                base.append([{"kind": KINDS[k], "start": a, "end": b} for k, a, b in spans])
                extra = []
                if known:
                    covered = sorted((a, b) for _, a, b in spans)
                    extra = [{"kind": TERM, "start": m.start(), "end": m.end()} for m in _TERM.finditer(text or "")
                             if term_hash(m[0].lower()) in known and not any(a < m.end() and m.start() < b for a, b in covered)]
                term.append(extra)
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            kept = [n for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(base, kind), pa.array(term, kind)],
                                             names=[*kept, "_base", "_terms"])
    return run


_SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def with_spans(docs: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with ``_base`` and ``_terms``: arrays of (kind, start, end)."""
    spark = docs.sparkSession
    tb.small_batches(spark)
    flagged = stored(disclosing_terms(docs, text_col, **settings).select("term").distinct())
    blocks = max(1, -(-flagged.count() // TERM_BLOCK))
    out = docs
    for i in range(blocks):
        part = flagged.where(F.pmod(F.xxhash64("term"), F.lit(blocks)) == i)
        known = spark.sparkContext.broadcast(frozenset(r.term for r in part.collect()))
        plain = out.withColumnRenamed(text_col, "text") if text_col != "text" else out
        kept = plain if i == 0 else plain.withColumnRenamed("_terms", "_so_far").drop("_base")
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
        out = kept.mapInArrow(_find(known), f"{schema}, _base {_SPANS}, _terms {_SPANS}")
        if i:
            out = out.withColumn("_terms", F.array_sort(F.concat("_so_far", "_terms"))).drop("_so_far")
        out = out.withColumnRenamed("text", text_col) if text_col != "text" else out
    return out


def _of(spans, kind: str):
    return F.filter(spans, lambda s: s["kind"] == kind)


def listed(spans, kinds: tuple[str, ...] = (*KINDS, TERM)):
    """Spans as text ``kind:start:end``, by kind as listed, then start, comma-joined (a column expression)."""
    parts = [_of(spans, k) for k in kinds]
    return F.array_join(F.transform(F.concat(*parts), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def found(docs: DataFrame, **settings) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` per row of ``docs``."""
    marked = with_spans(docs.select("doc_id", "text"), **settings)
    counts = [F.size(_of(F.col("_base"), k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return marked.select("doc_id", *counts, F.sha2(listed(F.col("_base")), 256).alias("base_sha256"),
                         listed(F.concat("_base", "_terms")).alias("spans"))


def cut(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the whole stretch becomes one."""
    out, at, end, kind = [], 0, -1, ""
    for a, b, k in sorted(spans):
        if a < end:
            end = max(end, b)
            continue
        if end >= 0:
            out.append(f"[{kind.upper()}]")
            at = end
        out.append(text[at:a])
        end, kind = b, k
    if end >= 0:
        out.append(f"[{kind.upper()}]")
        at = end
    return "".join(out) + text[at:]


def _cut(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[(s["start"], s["end"], s["kind"]) for s in (*a, *b)] for a, b in zip(
                batch.column("_base").to_pylist(), batch.column("_terms").to_pylist(), strict=True)]
            at = batch.schema.get_field_index(text_col)
            texts = [t if t is None or not s else cut(t, s) for t, s in zip(batch.column(at).to_pylist(), spans, strict=True)]
            clean = batch.set_column(at, text_col, pa.array(texts, pa.string()))
            yield clean.select([n for n in batch.schema.names if n not in ("_base", "_terms")])
    return run


def sanitised(docs: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with personal data and disclosing terms replaced in the text (and ``n_chars`` renewed, if there)."""
    out = with_spans(docs, text_col, **settings).mapInArrow(_cut(text_col), docs.schema)
    return out.withColumn("n_chars", F.char_length(text_col).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
