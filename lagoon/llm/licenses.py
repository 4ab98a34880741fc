"""License scans by conditional compression.

A text that could name a license (a cheap word test) is read whole, in
overlapping pieces of ``PIECE`` words, so line breaks never matter.  A template
is found where its words align in order with words of the text (a word found
counts 1, a word in between costs ``EXTRA_COST``) such that

- at least ``COVER`` of its words are there, with at most as many extra words
  in between as it has words;
- its names, variants and versions (``FAMILIES``, numbers) are all there, and no
  other word of those families lies in between (``3.0`` is ``3``).

All places of all templates are reported, with the missing and the extra words;
a place whose words all belong to better fitting places (LGPL read as GPL) is
not.  Each place is compressed with zstandard alone and once per template with
the template as raw dictionary; the relative saving orders equal fits and names
the nearest template.

Nulls and edges: a null or empty text has no findings; neighbouring lines with
hint words that no found place touches are one finding with a null license
(``unknown``); ties go to the larger saving, then by name; repeated rows are
scanned row by row; empty tables give empty results; columns other than id and
text are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagoon.llm import textbatch as tb

COVER, EXTRA_COST, PIECE = 0.8, 0.25, 512
_HINT = re.compile("|".join(x.replace(" ", r"[\W_]+") for x in (
    "licen[sc]", "copyright", "all rights reserved", "permission is hereby", "redistribution and use", "public domain",
    "warranty", "spdx", "creative commons", "cc (?:by|0)")) + r"|\bcc0\b", re.IGNORECASE)
_WORD = re.compile(r"[^\W_]+(?:\.\d+)*")
_VERSION = re.compile(r"v?(\d+(?:\.\d+)*?)(?:\.0+)*")

#: Words that tell licenses of one family apart; a template that has one agrees in all.
FAMILIES = [{"apache", "mit", "bsd", "gnu", "mozilla", "cc"}, {"lesser", "library", "affero", "gnu"},
            {"cc", "cc0", "by", "nc", "sa", "nd"}]

#: Notices and opening sentences of widespread licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                         "except in compliance with the License.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                "provided that the following conditions are met:",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                      "GNU General Public License as published by the Free Software Foundation, either version 2 of "
                      "the License, or (at your option) any later version.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                      "GNU General Public License as published by the Free Software Foundation, either version 3 of "
                      "the License, or (at your option) any later version.",
    "LGPL-2.1-notice": "This program is free software: you can redistribute it and/or modify it under the terms of "
                       "the GNU Lesser General Public License as published by the Free Software Foundation, either "
                       "version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of "
                       "the GNU Lesser General Public License as published by the Free Software Foundation, either "
                       "version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of "
                       "the GNU Affero General Public License as published by the Free Software Foundation, either "
                       "version 3 of the License, or (at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights. CC0 1.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "All-rights-reserved": "All rights reserved.",
}


def hint_blocks(text: str, longest: int = 4000) -> list[tuple[int, int]]:
    """[start, end) of neighbouring lines with hint words; a line longer than ``longest`` is cut around its hints."""
    out: list[tuple[int, int]] = []
    for m in _HINT.finditer(text):
        if out and m.end() <= out[-1][1]:
            continue
        start = text.rfind("\n", max(0, m.start() - longest), m.start()) + 1 or max(0, m.start() - longest)
        end = text.find("\n", m.end(), m.end() + longest)
        end = min(len(text), m.end() + longest) if end < 0 else end
        if end - start > longest:
            start, end = max(start, m.start() - 200, out[-1][1] if out else 0), min(end, m.end() + 400)
        elif out and start <= out[-1][1] + 1:
            start = out.pop()[0]
        out.append((start, end))
    return out


def words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def _plain(word: str) -> str:
    """A word as it is compared: versions without v and trailing zeros."""
    version = _VERSION.fullmatch(word)
    return version[1] if version else word


def _is_version(word: str) -> bool:
    return word[0].isdigit() and _VERSION.fullmatch(word) is not None


class Template:
    def __init__(self, text: str):
        self.words = words(text)
        self.plain = [_plain(w) for w in self.words]
        self.count, self.need = Counter(self.plain), -(-len(self.plain) * round(100 * COVER) // 100)
        self.at: dict[str, list[int]] = {}
        for i, w in enumerate(self.plain):
            self.at.setdefault(w, []).insert(0, i)
        self.strict = set().union(*[f for f in FAMILIES if f & set(self.plain)])
        self.versioned = any(map(_is_version, self.plain))
        hard = [i for i, w in enumerate(self.plain) if self.is_hard(w)]
        #: Word i may follow word ``self.back[i]`` or a later one, or (-1) be the first one found.
        self.back = [max((h for h in hard if h < i), default=-1) for i in range(len(self.plain))]
        self.last_hard = max(hard, default=-1)

    def is_hard(self, word: str) -> bool:
        return word in self.strict or (self.versioned and _is_version(word))

    def possible(self, count: Counter) -> bool:
        return sum(min(n, count[w]) for w, n in self.count.items()) >= self.need

    def best(self, have: list[str], lo: int, hi: int) -> tuple | None:
        """The best place in ``have[lo:hi]``: (score, [(template word, text word), ...])."""
        n, top = len(self.plain), None
        # Per template word: score + cost of the place (so that later extra words need no update), words found, chain.
        ends: list[tuple | None] = [None] * n
        for j in range(lo, hi):
            word = have[j]
            if word not in self.at:
                if self.is_hard(word):
                    ends = [None] * n
                continue
            fresh = []
            for i in self.at[word]:
                back = self.back[i]
                before = max((e for e in ends[max(back, 0):i] if e and j - e[2] < 2 * n), key=lambda e: e[0], default=None)
                if before and before[0] - EXTRA_COST * j >= 0:
                    fresh.append((i, (before[0] + 1 + EXTRA_COST, before[1] + 1, before[2], (before[3], i, j))))
                elif back < 0:
                    fresh.append((i, (1 + EXTRA_COST * (j + 1), 1, j, (None, i, j))))
            if self.is_hard(word):
                ends = [None] * n
            for i, e in fresh:
                if ends[i] is None or e[0] >= ends[i][0]:
                    ends[i] = e
                score = e[0] - EXTRA_COST * (j + 1)
                if e[1] >= self.need and i >= self.last_hard and (top is None or score > top[0]):
                    top = score, e[3]
        if top is None:
            return None
        chain, node = [], top[1]
        while node:
            chain.append(node[1:])
            node = node[0]
        return top[0], chain[::-1]

    def places(self, have: list[str]) -> Iterator[list[tuple[int, int]]]:
        todo = [(0, len(have))]
        while todo:
            lo, hi = todo.pop()
            found = self.best(have, lo, hi) if hi - lo >= self.need else None
            if found:
                yield found[1]
                todo += [(lo, found[1][0][1]), (found[1][-1][1] + 1, hi)]


class Scanner:
    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        self.templates = {n: Template(templates[n]) for n in self.names if words(templates[n])}
        self.overlap = 2 * max((len(t.words) for t in self.templates.values()), default=0)
        self.plain = zstandard.ZstdCompressor(level=9, write_content_size=False)
        self.with_dict = {}
        for n in self.names:
            data = zstandard.ZstdCompressionDict(templates[n].encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.with_dict[n] = zstandard.ZstdCompressor(level=9, dict_data=data, write_content_size=False, write_dict_id=False)

    def savings(self, block: str) -> list[tuple[float, str]]:
        """(relative saving, template), best first."""
        raw = block.encode("utf-8", "surrogatepass")
        alone = len(self.plain.compress(raw))
        return sorted(((1 - len(c.compress(raw)) / alone, n) for n, c in self.with_dict.items()), key=lambda x: (-x[0], x[1]))

    def found(self, text: str) -> list[dict]:
        """Every place of every template, also those inside of others, with ``used`` (numbers of the text's words)."""
        out, seen, first = [], set(), 0
        source, held = _WORD.finditer(text), []
        while True:
            new = [(m[0].lower(), m.start(), m.end()) for m in islice(source, max(PIECE, 2 * self.overlap) - len(held))]
            if not new:
                return out
            held += new
            have = [_plain(h[0]) for h in held]
            count = Counter(have)
            for name, t in self.templates.items():
                for chain in t.places(have) if t.possible(count) else ():
                    used = tuple(first + j for _, j in chain)
                    if (name, used) not in seen:
                        seen.add((name, used))
                        there, inside = {i for i, _ in chain}, {j for _, j in chain}
                        start, end = held[chain[0][1]][1], held[chain[-1][1]][2]
                        extra = [held[j][0] for j in range(chain[0][1], chain[-1][1]) if j not in inside]
                        out.append({"start": start, "end": end, "license": name, "used": used, "extra": extra,
                                    "missing": [w for i, w in enumerate(t.words) if i not in there]})
            first += len(held) - self.overlap if len(held) > self.overlap else 0
            held = held[-self.overlap:] if self.overlap else []

    def scan(self, text: str) -> list[dict]:
        out, claimed, tried = [], set(), []
        for f in self.found(text):
            ranked = self.savings(text[f["start"]:f["end"]])
            saving = next(s for s, n in ranked if n == f["license"])
            fit = len(f["used"]) - len(f["missing"]) - len(f["extra"])
            tried.append(((-fit, -saving, f["license"], f["start"]), f | {"nearest": ranked[0][1], "saving": float(saving)}))
        for _, f in sorted(tried, key=lambda x: x[0]):
            used = f.pop("used")
            if not claimed.issuperset(used):
                claimed.update(used)
                out.append(f)
        known, at, reach = sorted((f["start"], f["end"]) for f in out), 0, 0
        for start, end in hint_blocks(text):
            while at < len(known) and known[at][0] < end:
                reach = max(reach, known[at][1])
                at += 1
            if reach <= start:
                saving, nearest = (self.savings(text[start:end]) or [(0.0, None)])[0]
                out.append({"start": start, "end": end, "license": None, "nearest": nearest, "saving": float(saving),
                            "missing": None, "extra": None})
        return sorted(out, key=lambda f: (f["start"], f["end"], f["license"] or ""))


_FOUND = ("array<struct<start:bigint,end:bigint,license:string,nearest:string,saving:double,"
          "missing:array<string>,extra:array<string>>>")


def _scan(templates: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("license", pa.string()), ("nearest", pa.string()),
                                   ("saving", pa.float64()), ("missing", pa.list_(pa.string())), ("extra", pa.list_(pa.string()))]))
        for batch in batches:
            found = [scanner.scan(t) if t and _HINT.search(t) else [] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], names=["doc_id", "findings"])
    return run


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """``doc_id``, ``findings`` (array), ``licenses`` (distinct confirmed names), ``n_unknown`` per row of ``docs``."""
    tb.small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(_scan(templates), f"doc_id {kind}, findings {_FOUND}")
    names = F.array_sort(F.array_distinct(F.filter(F.transform("findings", lambda f: f["license"]), lambda n: n.isNotNull())))
    return out.withColumns({"licenses": names, "n_unknown": F.size(F.filter("findings", lambda f: f["license"].isNull())).cast("long")})
