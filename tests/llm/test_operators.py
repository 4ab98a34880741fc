"""The training-data operators against brute force on small tables, with nulls, empties, ties and extra columns."""

import collections
import hashlib
import re
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lagoon.llm import ann, chat, licenses, minhash, mixing, pieces, pii, quality, rindex, toxicity
from lagoon.llm import textbatch as tb
from lagoon.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, class string, n int, found string"


def _texts():
    rng = np.random.default_rng(5)
    vocab = ["alpha", "beta", "gamma", "delta", "omega", "the", "of", "Étion", "日本", "###", "x1"]
    out = []
    for _ in range(40):
        out.append(" ".join(rng.choice(vocab, rng.integers(3, 120)).tolist()))
    base = " ".join(f"word{i}" for i in range(200))
    near = [base.replace(f"word{k} ", f"other{k} ", 1) for k in range(0, 60, 3)]
    return [*out, base, base, *near, out[0], None, "", "   ", "\n\n", "one", "two words", "line\nline\nline\n", "mail a.b@c.d.org now",
            base + "\n" + out[1], "Permission ## 10.0.0.300 10.0.0.3 +44 (20) 7946-0958 4111 1111 1111 1111",
            "Licensed under the Apache License, Version 2.0."]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3 + 1, t, None if i % 7 == 0 else "ab"[i % 2], None if i % 5 == 0 else f"s{i % 4}", 1, 9, "c", 2, "f")
            for i, t in enumerate(_texts())]
    return spark.createDataFrame(rows, DOCS).repartition(4).checkpoint()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def _pairs(docs):
    return sorted((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())


def test_near_duplicates_equal_brute_force(docs, empty):
    sets = {}
    for i, t in _pairs(docs):
        w = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t))
        sets[i] = {tuple(w[j:j + 4]) for j in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert got == {i: (len(sets[i]), label[i], label[i] == i) for i in sets}
    assert minhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("block, shingles", [(256, 1 << 20), (16, 2500)])
def test_many_near_copies_below_the_threshold_are_confirmed_in_their_tasks(spark, monkeypatch, block, shingles):
    """Texts like one base but not like each other: nearly all pairs pass the estimate, few are links."""
    rng = np.random.default_rng(11)
    base = [f"word{i}" for i in range(200)]
    texts = []
    for i in range(100):
        words = list(base)
        for k in rng.choice(200, 4, replace=False):
            words[k] = f"own{i}x{k}"
        texts.append(" ".join(words))
    texts += [texts[3] + " tail", texts[3] + " tail two", texts[50]]
    sets = [{tuple(t.split()[j:j + 4]) for j in range(len(t.split()) - 3)} for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    label = list(range(len(sets)))
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", shingles, raising=False)
    handed, linked, confirmed, connect = [], [], minhash._confirmed, minhash.connect
    monkeypatch.setattr(minhash, "_confirmed", lambda pairs, *rest: handed.append(pairs.count()) or confirmed(pairs, *rest))
    monkeypatch.setattr(minhash, "connect", lambda edges: linked.append(edges.count()) or connect(edges))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert got == dict(enumerate(label)) and len(set(label)) > 50
    assert max(handed) <= 2 * len(texts) and max(linked) <= 2 * len(texts)


def test_repeated_bytes_equal_brute_force(docs, empty):
    seen, want = set(), {}
    for i, t in _pairs(docs):
        b = t.encode()
        gone, own = bytearray(len(b)), [b[j:j + 50] for j in range(len(b) - 49)]
        for j, w in enumerate(own):
            if w in seen:
                gone[j:j + 50] = b"\1" * 50
        seen.update(own)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        want[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rindex.deduplicated(docs).collect()}
    assert got == want
    assert rindex.deduplicated(empty).count() == 0


@pytest.mark.parametrize("hot_rows, hot_contexts", [(3, 10**9), (10**9, 3), (3, 3), (0, 0)])
def test_hot_anchors_are_dealt_out_and_stay_exact(spark, monkeypatch, hot_rows, hot_contexts):
    rng = np.random.default_rng(8)
    passage = " ".join(f"shared{i}" for i in range(30))
    texts = [f"{rng.integers(10**9)} {'abc'[i % 3]}{passage}{'xyz'[i % 3]} {rng.integers(10**9)}" for i in range(60)]
    texts += ["ab" * 300, "ab" * 40, "x" + "ab" * 300, passage * 3, None]
    docs = spark.createDataFrame([(i // 2 if i < 4 else i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)

    def stretches(found):
        return {r.doc_id: {b for s, e in r.found for b in range(s, e)} for r in found.collect()}

    def no_index(*_):
        raise AssertionError("an anchor above the limit was indexed in one task")

    want = stretches(rindex.repeats(docs, 10**9, 10**9))
    if not hot_contexts:
        monkeypatch.setattr(rindex, "covered_windows", no_index)
    got = stretches(rindex.repeats(docs, hot_rows, hot_contexts, 1))
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_run_index_finds_all_occurrences():
    rng = np.random.default_rng(3)
    for _ in range(60):
        strings = [bytes(rng.integers(97, 99, rng.integers(3, 14)).tolist()) for _ in range(rng.integers(2, 8))]
        docs, w = rng.integers(0, 4, len(strings)), 3
        got = {(s, o) for s, a, b in rindex.covered_windows(strings, docs, np.ones(len(strings), bool), w).tolist()
               for o in range(a, b + 1)}
        want = {(j, o) for j, s in enumerate(strings) for o in range(len(s) - w + 1)
                if any(docs[q] < docs[j] and s[o:o + w] in strings[q] for q in range(len(strings)))}
        assert got == want


def test_index_gets_only_contexts_that_share_more_than_their_anchor(monkeypatch):
    rng = np.random.default_rng(17)

    def noise(n):
        return bytes(rng.integers(33, 127, n).tolist())

    def value(gram):
        return tb.span_hashes(tb.prefix_hashes(np.frombuffer(gram, np.uint8)), np.zeros(1, int), np.array([16]))[0]

    # Per anchor (a gram of a small hash): thirty texts that share its 16 bytes only, four that share some 50 or more, and the stretches met by chance.
    texts = []
    for _ in range(20):
        gram, core = min((noise(16) for _ in range(300)), key=value), noise(60)
        texts += [noise(60) + gram + noise(60) for _ in range(30)]
        texts += [noise(5 + i) + core[i:] + core[:i % 2] + noise(40) for i in range(4)]
    texts += [b"ab" * 60, b"ab" * 45, b"abb" * 30, b"x" + b"ab" * 60]
    ids = rng.permutation(len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    a, b, anchor, _, owner = rindex.anchors(data, offsets)
    docs, strings = ids[owner], [data[x:y].tobytes() for x, y in zip(a, b, strict=True)]
    lowest = {k: docs[anchor == k].min() for k in set(anchor.tolist())}
    later = np.array([d > lowest[k] for d, k in zip(docs, anchor.tolist(), strict=True)])
    start = (a - offsets[owner]).astype(np.int32)
    table = pa.table({"anchor": anchor.view(np.int64), "doc_id": docs, "start": start, "later": later, "bytes": pa.array(strings, pa.binary())})
    handed, covered = [], rindex.covered_windows

    def counted(strings, docs, asked, *rest, **more):
        handed.append((len(strings), int(asked.sum())))
        return covered(strings, docs, asked, *rest, **more)

    monkeypatch.setattr(rindex, "covered_windows", counted)
    got = rindex._match((), table).to_pydict()
    got = {(d, j) for d, s, e in zip(got["doc_id"], got["start"], got["end"], strict=True) for j in range(s, e - 49)}
    want = {(docs[o], start[o] + j) for o, x, y in covered(strings, docs, later).tolist() for j in range(x, y + 1)}
    assert got == want and len(want) > 100
    crowded = sum(int(n) for n in np.unique(anchor, return_counts=True)[1] if n > 1)
    assert handed[0][0] < crowded / 2 and handed[0][1] < later.sum() / 2


def test_anchors_are_the_leftmost_least_over_slices():
    values = np.random.default_rng(4).integers(0, 9, (1 << 24) + 300).astype(np.uint64)
    got = rindex._leftmost_least(values, 35)
    assert len(got) == len(values) - 34
    for i in [*range(50), *range((1 << 24) - 80, (1 << 24) + 266)]:
        assert got[i] == i + values[i:i + 35].argmin()


def test_stretches_merge_to_maximal_runs():
    rng = np.random.default_rng(12)
    for _ in range(50):
        sizes = rng.integers(0, 40, 6)
        rows, a = rng.integers(0, 6, 12), rng.integers(0, 45, 12)
        b = a + rng.integers(1, 9, 12)
        line = [[any(r == i and x <= j < y for r, x, y in zip(rows, a, b, strict=True)) for j in range(n)] for i, n in enumerate(sizes)]
        want = [(i, j, next((k for k in range(j, len(gone)) if not gone[k]), len(gone)))
                for i, gone in enumerate(line) for j in range(len(gone)) if gone[j] and (j == 0 or not gone[j - 1])]
        assert [*zip(*(x.tolist() for x in rindex._merged(rows, a, b, sizes)), strict=True)] == want


def test_texts_are_shuffled_once_for_fetching_and_cutting(spark):
    passage = " ".join(f"shared{i}" for i in range(30))
    docs = spark.createDataFrame([(i, f"{'abc'[i % 3]}{passage}{'xyz'[i % 3]} {i * 7919}") for i in range(30)], "doc_id long, text string")
    path = scratch_path(spark, "texts")
    docs.write.parquet(path)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # as for tables too large to broadcast
    try:
        out = rindex.deduplicated(spark.read.parquet(path))
        assert out.count() == 30
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "ReusedExchange" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_rule_figures_equal_brute_force(docs, empty):
    got = {r.doc_id: r for r in quality.rule_figures(docs).collect()}
    for i, t in _pairs(docs):
        w = WORD.findall(t)
        grams = list(zip(w, w[1:], w[2:], strict=False))
        times = collections.Counter(grams)
        covered = {k for j, g in enumerate(grams) if times[g] > 1 for k in (j, j + 1, j + 2)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
    assert quality.rule_figures(empty).count() == 0


def test_cutoffs_need_enough_labels_and_hold_their_risk(spark):
    def figures(n_good, n_bad):
        rows = [(i, "en", False, 0.0 if i < n_good else 0.5) for i in range(n_good + n_bad)]
        f = spark.createDataFrame(rows, "doc_id long, lang string, base_failed boolean, symbol_rate double")
        return f.withColumns({r: F.lit(0.0) for r in quality.GRID if r != "symbol_rate"}), spark.createDataFrame(
            [(i, int(i < n_good)) for i in range(n_good + n_bad)], "doc_id long, quality int")

    f, labels = figures(600, 50)
    cut = {r.rule: r for r in quality.certified_cutoffs(f, labels).collect()}
    assert set(cut) == {"symbol_rate"} and cut["symbol_rate"].false_rejections == 0
    assert cut["symbol_rate"].bound == pytest.approx(0.97 ** 600, rel=1e-6)
    f, labels = figures(60, 50)
    assert quality.certified_cutoffs(f, labels).count() == 0
    assert quality.certified_cutoffs(f, labels.limit(0)).count() == 0


def test_repeat_words_are_exact_where_hash_bits_run_short(spark, monkeypatch):
    # Hashes of all windows equal: only the comparison of words tells them apart.
    monkeypatch.setattr(F, "xxhash64", lambda *_: F.lit(5).cast("long"))
    rows = [(1, " ".join(f"w{i}" for i in range(300))), (2, "a b c d a b c x a b c"), (3, "a a a a a"), (4, "a b"), (5, None), (6, "x y z")]
    got = {r.doc_id: r.n_repeat_words for r in quality.rule_figures(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 9, 3: 5, 4: 0, 5: 0, 6: 0}


def test_copies_of_a_good_text_do_not_certify(spark):
    def cutoffs(labels, texts):
        f = spark.createDataFrame([(i, "en", False, t, 0.1 if i >= 1000 else 0.0) for i, t in texts],
                                  f"doc_id long, lang string, base_failed boolean, {quality.TEXT_KEY} string, symbol_rate double")
        f = f.withColumns({r: F.lit(0.0) for r in quality.GRID if r != "symbol_rate"})
        return {r.rule: r.n_good for r in quality.certified_cutoffs(f, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}

    bad = [(1000 + i, 0) for i in range(30)]
    texts = [(i, f"t{i % 60}") for i in range(600)] + [(i, f"bad{i}") for i, _ in bad]
    few = [(i, 1) for i in range(60)]
    assert not cutoffs(few + bad, texts)
    assert not cutoffs(few * 10 + bad, texts)                                   # labels repeated
    assert not cutoffs([(i, 1) for i in range(600)] + bad, texts)               # texts repeated
    own = [(i, f"t{i}") for i in range(600)] + texts[600:]
    assert cutoffs([(i, 1) for i in range(600)] + bad, own) == {"symbol_rate": 600}
    assert cutoffs([(i, 1) for i in range(600)] + [(0, 0)] + bad, own) == {"symbol_rate": 599}     # labels that disagree


def test_mix_meets_targets(spark, docs, empty):
    mixed = mixing.mix(mixing.measured(docs))
    rows = mixed.collect()
    again = mixing.mix(mixing.measured(docs.repartition(3))).collect()
    assert sorted((r.doc_id, r.taken, tuple(r.shards)) for r in rows) == sorted((r.doc_id, r.taken, tuple(r.shards)) for r in again)
    assert all(r.taken in (0, r.size, 2 * r.size) and len(r.shards) == r.copies for r in rows)
    size, taken, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want, capped = {}, set()
    while True:
        left = 1.5 * sum(size.values()) - sum(2 * size[s] for s in capped)
        want = {s: 2 * size[s] if s in capped else left * weight[s] / sum(weight[x] for x in order if x not in capped) for s in order}
        above = {s for s in order if s not in capped and want[s] > 2 * size[s]}
        if not above:
            break
        capped |= above
    assert target == {s: pytest.approx(want[s]) for s in order}
    assert all(abs(taken[s] - want[s]) <= 130 for s in order)
    assert mixing.mix(mixing.measured(empty)).count() == 0
    assert mixing.shard_rows(mixed).count() == sum(len(r.shards) for r in rows)


@pytest.mark.parametrize("first", [0, 1000, 5000])
def test_a_long_document_does_not_stop_a_mix_short(spark, first):
    rows = [(first + i, "w " * 200, "a") for i in range(300)] + [(first + 300, "w " * 60_000, "a"), (first + 301, "w " * 60_000, "b"),
                                                              (first + 302, None, "b"), (first + 303, "w " * 15_000, "b")]
    rows = [(i, t and f"{t}{i}", s) for i, t, s in rows]
    got = mixing.mix(mixing.measured(spark.createDataFrame(rows, "doc_id long, text string, source string"))).collect()
    for source in "ab":
        mine = [r for r in got if r.doc_id < first + 301] if source == "a" else [r for r in got if r.doc_id >= first + 301]
        taken, goal = sum(r.taken for r in mine), mine[0].target
        assert taken <= goal and all(r.taken <= 2 * r.size and len(r.shards) == r.copies for r in mine)
        if source == "a":
            assert taken > 0.99 * goal


def test_pipeline_mix_keeps_columns_named_like_its_own(spark):
    import corpus_pipeline
    rows = [(i, f"text of {i}", "ab"[i % 2], f"t{i}", [i]) for i in range(40)] + [(None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, target string, shards array<long>")
    out = corpus_pipeline.mix_sources(spark, docs, None)
    assert out.columns == docs.columns and out.schema["shards"].dataType == docs.schema["shards"].dataType
    assert {r.doc_id for r in out.collect()} <= {r[0] for r in rows}
    assert all((r.target, r.shards) == (f"t{r.doc_id}", [r.doc_id]) for r in out.where("doc_id IS NOT NULL").collect())


def test_quotas_are_exact(spark):
    counts = spark.createDataFrame([(0, 7), (1, 0), (2, 90)], "_rank int, units int")
    quotas = mixing.split_quotas(counts, 3, 1).collect()
    total = collections.Counter()
    for r in quotas:
        total[r._rank] += r.quota
    assert total == {0: 7, 1: 0, 2: 90} and all(r.quota >= 0 for r in quotas)
    assert {sum(r.quota for r in quotas if r.shard == s) for s in range(8)} <= {12, 13}


def test_chat_round_trip_and_layouts(spark):
    tricky = "a\\ <|end|>\n</s>[INST] \\. <<SYS>> <|x"
    rows = spark.createDataFrame([(1, 0, "user", tricky), (1, 1, "assistant", None), (1, 2, "assistant", "yes <|"), (2, None, None, None)],
                                 "conv_id long, turn long, role string, text string")
    out = chat.formatted(chat.canonical(chat.as_records(rows))).withColumns({
        "back": chat.parse(F.col("formatted")), "loss": chat.loss_text(F.col("formatted"), F.col("loss_spans"))})
    got = {r.conv_id: r for r in out.collect()}
    assert [(t.role, t.text) for t in got[1].back] == [("user", tricky), ("assistant", ""), ("assistant", "yes <|")]
    assert got[1].loss == "yes <|" and [(t.role, t.text) for t in got[2].back] == [("", "")]
    layouts = ['{"prompt":"p","response":"[{\\"a\\":1}]"}', '{"instruction":"i","input":"n","output":"o","id":4}',
               '{"conversations":[{"from":"human","value":"h"},{"from":"gpt","value":"g"}]}', '{"foo":1}', "no", None]
    df = chat.canonical(spark.createDataFrame([(i, x) for i, x in enumerate(layouts)], "i int, record string"))
    turns = {r.i: r.turns and [(t.role, t.text) for t in r.turns] for r in df.collect()}
    assert turns[0] == [("user", "p"), ("assistant", '[{"a":1}]')]
    assert turns[1] == [("user", "i"), ("user", "n"), ("assistant", "o")]
    assert turns[2] == [("user", "h"), ("assistant", "g")]
    assert turns[3] is None and turns[4] is None and turns[5] is None


def test_pieces_round_trip_and_best_path(spark, docs, empty):
    import os
    if not os.path.exists(pieces.MODEL):
        pytest.skip("no tokenizer files")
    rows = pieces.encoded(docs)
    back = {r.doc_id: r.text for r in pieces.decoded(rows).collect()}
    assert back == dict(_pairs(docs))
    assert all(r.round_trip for r in rows.collect())
    p = pieces.load()
    by = {p.flat[p.offsets[i]:p.offsets[i + 1]].tobytes(): i for i in range(len(p.score)) if i not in set(p.byte_id.tolist())}
    for text in ["hello world", "  a  b\n\nc ", "日本語 \U0001f389é", "ab" * 60 + " " + "x" * 90]:
        raw = (" " + text).encode()
        best = {0: 0.0}
        for i in range(len(raw)):
            if i in best:
                size = 1 if raw[i] < 0x80 else 2 if raw[i] < 0xE0 else 3 if raw[i] < 0xF0 else 4
                for j in range(i + 1, min(len(raw), i + p.longest) + 1):
                    if raw[i:j] in by:
                        best[j] = max(best.get(j, -1e18), best[i] + p.score[by[raw[i:j]]])
                if raw[i:i + size] not in by:
                    best[i + size] = max(best.get(i + size, -1e18), best[i] + p.unknown)
        tokens, _ = pieces.encode(p, np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
        plain = [t for t in tokens.tolist() if t not in set(p.byte_id.tolist())]
        bare = [t for t in tokens.tolist() if t in set(p.byte_id.tolist())]
        chars = sum(1 for t in bare if not 0x80 <= p.flat[p.offsets[t]] < 0xC0)
        assert sum(p.score[t] for t in plain) + chars * p.unknown == pytest.approx(best[len(raw)])
    assert pieces.encoded(empty).count() == 0


def _naive_spans(t):
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        g = re.sub("[ -]", "", m[0])
        if 13 <= len(g) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(g[::-1])) % 10 == 0:
            out.append(("card", m))
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [(k, m.start(), m.end()) for k, m in out]


def test_base_patterns_equal_plain_regex(docs, empty):
    rng = np.random.default_rng(2)
    parts = ["a", "b.c", "@", "@x.y", "@@", "1.2.3.4", ".5", "256.1.1.1", "+4", "9", " ", "-", "(", ")", "4111111111111111", "00012", "é", "\n"]
    for _ in range(3000):
        t = "".join(rng.choice(parts, rng.integers(1, 14)).tolist())
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(t)] == _naive_spans(t), t
    for r in pii.found(docs).collect():
        pass
    assert pii.found(empty).count() == 0


def test_disclosing_terms_are_found_and_removed(spark):
    names = [f"filler{c}{d}" for c in "abcdefgh" for d in "klmnopqr"]
    rows = [(i, f"Mr Quixwright writes from {names[i]} {names[63 - i]} quix@example.org today {names[i % 7]}") for i in range(12)]
    rows += [(100 + i, f"plain {names[i % 64]} today and {names[(i * 5) % 64]}") for i in range(5000)]
    rows += [(9000, "Quixwright again"), (9001, None), (9002, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.found(df, bits=6.0).collect()}
    assert "term:3:13" in spans[0] and spans[9000] == "term:0:10" and spans[100] == "" and spans[9001] == ""
    clean = {r.doc_id: r.text for r in pii.sanitised(df, bits=6.0).collect()}
    assert "[EMAIL]" in clean[0] and "Quixwright" not in clean[0] and clean[9000] == "[TERM] again" and clean[9001] is None


def test_licenses(docs, empty, spark):
    found = {r.doc_id: r.licenses for r in licenses.scan(docs).collect()}
    assert [x for x in found.values() if x] == [["Apache-2.0"]]
    odd = spark.createDataFrame([(1, "some license of our own making, ask us"), (2, "Released under the MIT Licence.\nx")], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(odd).collect()}
    assert got[1].licenses == [] and got[1].n_unknown == 1
    assert got[2].licenses == ["MIT"] and got[2].findings[0].missing == ["license"]
    assert licenses.scan(empty).count() == 0


def test_wrapped_and_neighbouring_licenses_are_all_found():
    def found(text):
        return [(f["license"], f["missing"], f["extra"]) for f in licenses.Scanner(licenses.TEMPLATES).scan(text)]

    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated "
           "documentation files (the \"Software\"), to deal\nin the Software without restriction, including")
    bsd = ("# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that "
           "the following conditions\n# are met:")
    gpl = ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU {}General Public "
           "License as published by\nthe Free Software Foundation, either version {} of the License, or\n(at your option) any later version.")
    for text, name in ((mit, "MIT-text"), (bsd, "BSD-text"), (gpl.format("", 3), "GPL-3.0-notice"), (gpl.format("", 2), "GPL-2.0-notice"),
                       (gpl.format("Lesser ", 3), "LGPL-3.0-notice"), (gpl.format("Affero ", "3.0"), "AGPL-3.0-notice")):
        assert found(text) == found("plain words before " * 400 + text + " and after" * 400) == [(name, [], [])]
    two = "Licensed under CC BY-SA 4.0.\nReleased under the MIT License.\nAll rights reserved.\n\nsome license of our own\n"
    assert [f[0] for f in found(two)] == ["CC-BY-SA-4.0", "MIT", "All-rights-reserved", None]
    assert [f[0] for f in found("\n".join(sorted(licenses.TEMPLATES.values())))] == [
        n for n, _ in sorted(licenses.TEMPLATES.items(), key=lambda x: x[1])]
    for other in ("Released under the Foo License.", "Licensed under CC BY 3.0.", "Licensed under CC BY-NC-ND 4.0.",
                  "This work is licensed under the GNU General Public License, version 2.1."):
        assert [f[0] for f in found(other)] == [None]


def test_toxicity_learns_misspells_and_quotes(spark):
    rng = np.random.default_rng(7)
    words = [a + b for a in ("ta", "mo", "ri", "lu", "ke") for b in ("nor", "sil", "dap", "vem", "gor")]
    rows, labels = [], []
    for i in range(400):
        w = rng.choice(words, 40).tolist()
        if i % 4 == 0:
            w[rng.integers(40)] = "grumbok"
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 4 == 0)))
    rows += [(1000, "tanor grumbqk mosil"), (1001, None), (1002, "tanor mosil"), (1003, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.scores(docs, known).collect()}
    held = [got[i] for i, _ in labels if got[i].held_out]
    assert held and all(r.predicted == int(r.doc_id % 4 == 0) for r in held)
    assert got[1000].score > got[1002].score and 0 <= got[1001].score < 0.3
    assert toxicity.quoted('he said "grumbok" twice', 9) and not toxicity.quoted("you grumbok", 4)
    assert {r.score for r in toxicity.scores(docs, known.limit(0)).collect()} == {toxicity.BASE}
    assert toxicity.scores(docs.limit(0), known).count() == 0


def test_neighbours_recall_and_exact_scores(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(900, 16)).astype(np.float32)
    x[100:140] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16),
                                                         (2004, [1.0, None] + [0.0] * 14), (2005, [1.0] * 3), (None, x[0].tolist())]
    got = collections.defaultdict(list)
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(range(0, 900, 20))
    hits = 0
    for q, found in got.items():
        s = x.astype(float) @ x[q].astype(float)
        s[q] = -np.inf
        best = sorted(range(900), key=lambda i: (-round(s[i], 9), i))[:20]
        hits += len(set(best) & {v for _, v, _ in found})
        assert [r for r, _, _ in found] == list(range(1, 21)) and q not in {v for _, v, _ in found}
        assert all(abs(score - s[v]) < 1e-9 for _, v, score in found)
    assert hits / (20 * len(got)) >= 0.9
    same = [v for _, v, _ in got[100] if 100 <= v < 140]
    assert len(same) >= 15 and same == list(range(101, 101 + len(same)))      # equal scores: smaller ids first
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_nearly_equal_candidates_are_ranked_exactly():
    rng = np.random.default_rng(12)
    base = rng.normal(size=32).astype(np.float32)
    near = np.repeat(base[None], 3000, axis=0)
    near[np.arange(3000), rng.integers(0, 32, 3000)] *= (1 + rng.integers(-3, 4, 3000) * 2.0 ** -23).astype(np.float32)
    k, names = 5, rng.permutation(3000)
    kind = pa.list_(pa.float32())
    table = pa.table({"class": names, "vector": pa.array(near.tolist(), kind), "leaf": rng.integers(0, 4, 3000)})
    asked = pa.table({"query": [7], "vector": pa.array([base.tolist()], kind), "leaves": pa.array([[0, 1, 3]], pa.list_(pa.int64()))})
    score = ann.inner_products(np.repeat(base[None], 3000, axis=0), near)
    opened = np.flatnonzero(table.column("leaf").to_numpy() != 2)
    want = [int(names[i]) for i in sorted(opened, key=lambda i: (-score[i], names[i]))[:k + 1]]
    assert [h["class"] for h in ann._rank(k)(table, asked).column("hits").to_pylist()[0]] == want


def test_pipeline_stages_keep_columns_and_survive_empty_tables(spark, docs, empty, tmp_dir):
    import corpus_pipeline
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_dir}/labels.parquet")
    for name, table in (("full", docs), ("empty", empty)):
        frame = table.select("doc_id", "text", "lang", "source", "n_chars")
        for step, (_, stage) in enumerate(corpus_pipeline.STAGES):
            path = f"{tmp_dir}/{name}-{step}"
            stage(spark, frame, tmp_dir).write.parquet(path)
            if step < len(corpus_pipeline.STAGES) - 1:
                assert spark.read.parquet(path).columns == frame.columns
            frame = spark.read.parquet(path)
        assert (frame.count() > 0) == (name == "full")


def test_entry_registers_the_queries():
    sys.path.insert(0, "")
    import __spark_entry__
    names = set(__spark_entry__.queries())
    assert {n for n in names if n.startswith("op")} >= {f"op{i}_" + n for i, n in enumerate(
        ["mix", "license", "quality", "chat", "pieces", "rindex", "pii", "toxicity", "minhash", "ann"], 1)}
    assert "pipeline" in names
