"""Toxicity: a lexicon trie crossed with Levenshtein automata, and context windows.

Lexicon: learned from labelled rows of the training folds.  Word beginnings
(stems) of toxic texts that are many times rarer in other texts are candidates;
a greedy cover of the toxic texts picks stems, so that words which merely occur
in copies of toxic texts add nothing, and stems of like support are added.  The
fit reads at most ``TOXIC_ROWS`` toxic and ``OTHER_ROWS`` other labelled texts, in
hash order of the id, and the lexicon holds at most ``STEMS`` stems.

Matching: the stems' trie times an automaton of one edit (insertion, deletion,
substitution; stems of ``FUZZY_FROM`` letters or more, first letter fixed) is made
deterministic as states are met, and steps through all words of a batch at once.

Score: hits are split by their context window into abuse and quotation (quote
marks around the hit, or a reporting word before it).  A logistic model on the
counts, fitted on the same bounded sample with class weights of all labelled
training rows, gives the score.  Only the text enters a score.

Nulls and edges: null and empty texts have no hits and get the model's base
score; without toxic or without other training rows, or without labels, scores
are a fixed ``BASE``; labels that are null, or whose document is missing, don't
count; repeated ids are scored row by row; a null id is not held out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagoon.llm import textbatch as tb
from lagoon.llm.tables import stored

TOXIC_ROWS, OTHER_ROWS, STEMS = 4000, 8000, 400
FUZZY_FROM, SHORTEST, LONGEST = 6, 3, 12
BASE, NEAR = 0.05, 0.7
LETTERS = re.compile(r"[^\W_]+")
#: Words that report another's speech, and quote marks.
REPORTING = {"said", "says", "quote", "quoted", "called", "word", "term", "dit", "mot", "sagte", "wort", "dijo", "palabra"}
QUOTES = "\"'`‘’“”„«»"
FEATURES = 4


def stems_of(text: str) -> set[str]:
    """Beginnings of the text's words, ``SHORTEST`` to ``LONGEST`` letters."""
    return {w[:n] for w in set(LETTERS.findall(text.lower())) for n in range(SHORTEST, min(len(w), LONGEST) + 1)}


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tb.chunks(batch, "text"):
            count = Counter()
            for text in part.column("text").to_pylist():
                count.update(stems_of(text or ""))
            yield pa.RecordBatch.from_arrays([pa.array(count.keys(), pa.string()), pa.array(count.values(), pa.int64())],
                                             names=["stem", "n"])


def _stem_hits(stems: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.chunks(batch, "text"):
                found = [sorted(stems[s] for s in stems_of(t or "") if s in stems) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(found, pa.list_(pa.int32()))],
                                                 names=["toxic", "found"])
    return run


def choose_stems(names: list[str], texts: list[tuple[int, list[int]]], support: float = 0.01, lift: float = 20.0) -> dict[str, float]:
    """Greedy cover of the toxic texts (label 1) by stems that others (label 0) seldom have.

    Returns each stem with its weight: the log odds of toxic against other texts, smoothed by half a text.
    """
    toxic = [f for y, f in texts if y]
    other = Counter(s for y, f in texts if not y for s in f)
    n_other = max(1, sum(1 for y, _ in texts if not y))
    holders: dict[int, set[int]] = {}
    for i, f in enumerate(toxic):
        for s in f:
            holders.setdefault(s, set()).add(i)
    least = max(2, support * len(toxic))
    usable = {s: h for s, h in holders.items() if len(h) >= least
              and (len(h) / max(1, len(toxic))) / ((other[s] + 0.5) / n_other) >= lift}

    def longest(s: int) -> int:
        same = [t for t in usable if names[t].startswith(names[s]) and len(usable[t]) >= 0.97 * len(usable[s])]
        return max(same, key=lambda t: (len(names[t]), names[t]))

    picked: list[int] = []
    left = set(range(len(toxic)))
    while left and len(picked) < STEMS:
        s = max(usable, key=lambda t: (len(usable[t] & left), len(usable[t]), names[t]), default=None)
        if s is None or not usable[s] & left:
            break
        s = longest(s)
        picked.append(s)
        left -= usable[s]
        if len(usable[s]) < least:
            break
    if picked:
        like = 0.3 * float(np.median([len(usable[s]) for s in picked]))
        for s in sorted(usable, key=lambda t: (-len(usable[t]), names[t])):
            if len(usable[s]) >= like and len(picked) < STEMS:
                s = longest(s)
                if not any(names[s].startswith(names[p]) or names[p].startswith(names[s]) for p in picked):
                    picked.append(s)
    n_toxic = max(1, len(toxic))
    return {names[s]: float(np.log((len(usable[s]) + 0.5) / n_toxic) - np.log((other[s] + 0.5) / n_other))
            for s in sorted(set(picked), key=lambda s: names[s])}


class Matcher:
    """The product of the stems' trie and one-edit automata, made deterministic as needed.

    A state is a set of (trie node, edits so far).  A word's verdict is the
    weight of the best stem it begins with, at ``NEAR`` of it after an edit, or 0.
    """

    def __init__(self, stems: dict[str, float]):
        self.children: list[dict[str, int]] = [{}]
        self.final: dict[int, tuple[int, float]] = {}
        for stem, weight in sorted(stems.items()):
            node = 0
            for c in stem:
                if c not in self.children[node]:
                    self.children.append({})
                    self.children[node][c] = len(self.children) - 1
                node = self.children[node][c]
            self.final[node] = (len(stem), max(weight, 0.01))
        letters = sorted({c for s in stems for c in s})
        self.symbols = ["", *letters, None]          # 0: between words; the last: any other letter or digit
        self.states: list[frozenset] = [frozenset()]
        self.ids = {self.states[0]: 0}
        self.verdicts = [0.0]
        self.start = self._id(frozenset({(0, 0)}))
        self.table = np.full((64, len(self.symbols)), -1, np.int32)
        self.lut = np.zeros(0x110000, np.uint16)
        ordinals = np.arange(0x3000)
        self.lut[0x3000:] = len(self.symbols) - 1
        self.lut[:0x3000] = [len(self.symbols) - 1 if chr(o).isalnum() else 0 for o in ordinals]
        for i, c in enumerate(letters, 1):
            self.lut[ord(c)] = i

    def _id(self, state: frozenset) -> int:
        if state not in self.ids:
            self.ids[state] = len(self.states)
            self.states.append(state)
            self.verdicts.append(max((self.final[n][1] * (NEAR if e else 1.0) for n, e in state
                                      if n in self.final and (e == 0 or self.final[n][0] >= FUZZY_FROM)), default=0.0))
        return self.ids[state]

    def _step(self, state: int, symbol: int) -> int:
        c, out = self.symbols[symbol], set()
        for node, edits in self.states[state]:
            hit = self.children[node].get(c) if c else None
            if hit is not None:
                out.add((hit, edits))
            if edits == 0 and node:
                out.add((node, 1))                                        # an extra letter in the word
                for child in self.children[node].values():
                    out.add((child, 1))                                   # another letter
                    skipped = self.children[child].get(c) if c else None  # a letter left out
                    if skipped is not None:
                        out.add((skipped, 1))
        return self._id(frozenset((n, e) for n, e in out if e == 0 or (n, 0) not in out))

    def verdict(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and verdict of every word of a code-point array that has one, and the starts of all words."""
        symbols = self.lut[points]
        inside = symbols > 0
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        starts = np.flatnonzero(begin)
        best = np.zeros(len(starts))
        live, at, state = np.arange(len(starts)), starts.copy(), np.full(len(starts), self.start, np.int32)
        symbols = np.append(symbols, np.uint16(0))
        while len(live):
            s = symbols[at]
            keep = s > 0
            live, at, state, s = live[keep], at[keep], state[keep], s[keep]
            if not len(live):
                break
            after = self.table[state, s]
            new = np.flatnonzero(after < 0)
            if len(new):
                for code in np.unique(state[new].astype(np.int64) * len(self.symbols) + s[new]):
                    a, b = divmod(int(code), len(self.symbols))
                    to = self._step(a, b)
                    while len(self.table) < len(self.states):
                        self.table = np.vstack([self.table, np.full_like(self.table, -1)])
                    self.table[a, b] = to
                after = self.table[state, s]
            got = np.asarray(self.verdicts)[after]
            best[live] = np.maximum(best[live], got)
            go = after > 0
            live, at, state = live[go], at[go] + 1, after[go]
        hit = np.flatnonzero(best)
        return starts[hit], best[hit], starts


def quoted(text: str, at: int) -> bool:
    """Whether the hit at code point ``at`` is quoted or reported rather than used."""
    before, after = text[max(0, at - 40):at], text[at:at + 60]
    words = LETTERS.findall(before.lower())[-3:]
    opened = next((c for c in reversed(before) if c in QUOTES or c == "\n"), "\n")
    closed = next((c for c in after if c in QUOTES or c == "\n"), "\n")
    return (opened != "\n" and closed != "\n") or bool(REPORTING.intersection(words))


def features(texts: list[str], matcher: Matcher) -> np.ndarray:
    """Per text: best and summed weight of abusive hits, log count of quoted hits, weight per 10 words."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    begins = ends - [len(t) + 1 for t in lowered]
    out = np.zeros((len(texts), FEATURES))
    starts, kind, words = matcher.verdict(points)
    owner = np.searchsorted(ends, starts, side="right")
    count = np.bincount(np.searchsorted(ends, words, side="right"), minlength=len(texts))
    for i, at, v in zip(owner, starts, kind, strict=True):
        if quoted(lowered[i], int(at - begins[i])):
            out[i, 2] += 1
        else:
            out[i, 0] = max(out[i, 0], v)
            out[i, 1] += v
    out[:, 3] = np.minimum(1.0, out[:, 1] / np.maximum(count, 1))
    out[:, 1:3] = np.log1p(out[:, 1:3])
    return out


def _featured(stems: dict[str, float], keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(stems)
        for batch in batches:
            for part in tb.chunks(batch, "text"):
                x = features([t or "" for t in part.column("text").to_pylist()], matcher)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], pa.array(list(x), pa.list_(pa.float64()))], names=[*keep, "x"])
    return run


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights (intercept last) by Newton steps."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    penalty = ridge * np.eye(a.shape[1])
    penalty[-1, -1] = 1e-6
    weight = weight / weight.mean()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hessian = (a * (weight * p * (1 - p))[:, None]).T @ a / len(a) + penalty
        step = np.linalg.solve(hessian, a.T @ (weight * (y - p)) / len(a) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def scores(docs: DataFrame, labels: DataFrame, held_fold: int = 2, folds: int = 4) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``; only labels outside the held-out fold are read."""
    tb.small_batches(docs.sparkSession)
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == held_fold, F.lit(False))
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held)
    total = {r.toxic: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    turn = F.xxhash64("doc_id")
    chosen = known.where("toxic = 1").orderBy(turn, "doc_id").limit(TOXIC_ROWS).union(
        known.where("toxic = 0").orderBy(turn, "doc_id").limit(OTHER_ROWS))
    texts = docs.select("doc_id", "text")
    # At most TOXIC_ROWS + OTHER_ROWS narrow rows are broadcast.
    sample = stored(texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic").dropDuplicates(["text", "toxic"]))
    stems: dict[str, float] = {}
    if min(total.get(0, 0), total.get(1, 0)) > 0:
        least = max(2, 0.01 * min(total[1], TOXIC_ROWS) * 0.5)
        counts = (sample.where("toxic = 1").select("text").mapInArrow(_stem_counts, "stem string, n long")
                  .groupBy("stem").agg(F.sum("n").alias("n")).where(F.col("n") >= least))
        names = sorted(r.stem for r in counts.select("stem").collect())
        found = sample.mapInArrow(_stem_hits({s: i for i, s in enumerate(names)}), "toxic int, found array<int>").collect()
        stems = choose_stems(names, [(r.toxic, r.found) for r in found])
    if not stems:
        score = F.lit(BASE)
        return texts.select("doc_id", held.alias("held_out"), score.alias("score"), (score >= 0.3).cast("int").alias("predicted"))
    rows = sample.mapInArrow(_featured(stems, ["toxic"]), "toxic int, x array<double>").collect()
    x, y = np.array([r.x for r in rows]), np.array([r.toxic for r in rows], float)
    share = {v: total[v] / max(1, int((y == v).sum())) for v in (0, 1)}
    w = fit_logistic(x, y, np.where(y == 1, share[1], share[0]))
    out = texts.mapInArrow(_featured(stems, ["doc_id"]), "doc_id long, x array<double>")
    logit = sum((F.col("x")[i] * float(w[i]) for i in range(FEATURES)), F.lit(float(w[-1])))
    score = 1 / (1 + F.exp(-logit))
    return out.select("doc_id", held.alias("held_out"), score.alias("score"),
                      F.when(score >= 0.3, 1).otherwise(0).cast("int").alias("predicted"))

