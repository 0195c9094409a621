"""License scans: MinHash bands over overlapping windows, then containment.

A text's words (letters and digits, lower-cased) are laid out as shingles of
five. For every size class of templates the text is covered by windows of the
class's size and a quarter more, a quarter apart, so that an occurrence lies
whole in a window. Window and template have bands of ``rows`` min-hashes each;
an occurrence with similarity J meets its template in a band with probability
1 - (1 - J^rows)^bands. A window that holds the share c (the containment) of a
template's s shingles has J >= c s / (span + s - c s), 0.4 to 1 by class; each
class has as many bands as meet that J with 0.999 in a window. A met pair
is verified exactly: at least ``containment`` of the template's shingles stand
in the window (a template of fewer than five words is one shingle of all its
words).

Templates are few and fixed by the caller (``MAX_TEMPLATES``, an error
beyond). ``NOTICES`` holds short public license notices.

Defined results: null and empty texts have no match; of a template's
overlapping matches in a text one row is returned, from the first matched
word to the last; repeated rows repeat their result; an empty table gives an
empty table. Only the named columns are read, so extra columns of any name are
ignored. Texts are scanned whole.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import id_text, slices
from lakeops.llm.passages import WordHashes, _mix

SHINGLE, MAX_TEMPLATES = 5, 10_000
#: Bytes of text scanned together: its columns stay in a processor's cache.
SMALL = 512 << 10
WORDS = re.compile(r"[^\W_]+").findall

# The wording of public license notices.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "BSD-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def _shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    n = max(0, len(words) - size + 1)
    out = np.full(n, size, "u8")
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n]
    return _mix(out)


@dataclass
class Templates:
    """Templates in classes of like size, with the bands of each."""

    names: list
    texts: list
    bands: int | None  # derived from the containment, if None
    rows: int
    containment: float = 0.8

    def __post_init__(self):
        memo = WordHashes()
        self.classes: dict[tuple[int, int], list] = {}  # (words in a shingle, size) -> templates
        for i, text in enumerate(self.texts):
            words = np.array([memo[w] for w in WORDS(text.lower())], "u8")
            if not len(words):
                continue
            of = min(SHINGLE, len(words))
            found = np.unique(_shingles(words, of))
            size = len(words) - of + 1
            # classes a quarter apart, so that a class's windows suit its templates
            grade = next(g for g in _grades() if g >= size)
            self.classes.setdefault((of, grade), []).append((i, found))
        self.bands_of = {cls: self.bands or max(_bands_for(len(found), _layout(cls[1])[1], self.containment, self.rows) for _, found in templates) for cls, templates in self.classes.items()}
        self.most = max(self.bands_of.values(), default=0)
        seeds = _mix(np.arange(1, 2 * self.most * self.rows + 1, dtype="u8") * np.uint64(0xD6E8FEB86659FD93)).astype("u4")
        self.seeds = [(s, m | np.uint32(1)) for s, m in zip(seeds[::2], seeds[1::2])]
        # per class and band: the first rows' values (and a table of their upper
        # halves, for whole columns at once), and the templates of each whole band
        self.first: dict[tuple, tuple] = {}
        self.bucket: dict[tuple, dict] = {}
        for cls, templates in self.classes.items():
            for b in range(self.bands_of[cls]):
                bucket: dict[tuple, list] = {}
                for t, (_, found) in enumerate(templates):
                    bucket.setdefault(self._band(_short(found), b), []).append(t)
                values = np.array(sorted({k[0] for k in bucket}), "u4")
                upper = np.zeros(1 << 16, bool)
                upper[values >> np.uint32(16)] = True
                self.first[cls, b], self.bucket[cls, b] = (upper, values), bucket

    def _hash(self, base: np.ndarray, k: int) -> np.ndarray:
        seed, factor = self.seeds[k]
        return (base ^ seed) * factor

    def _band(self, base: np.ndarray, b: int) -> tuple:
        """A band's least hashes over a set of shingles."""
        return tuple(int(self._hash(base, b * self.rows + r).min()) for r in range(self.rows))

    def scan_many(self, words: list[np.ndarray], containment: float) -> list[tuple[int, int, int, int, float]]:
        """(text, template, first word, end word, containment) in word-hash sequences."""
        hits: list[tuple] = []
        for of in {of for of, _ in self.classes}:
            tokens = [_shingles(w, of) for w in words]
            first = np.cumsum([0, *map(len, tokens)])
            base = np.concatenate(tokens) if tokens else np.empty(0, "u8")
            if not len(base):
                continue
            short = _short(base)
            asked: set[tuple] = set()
            for b in range(self.most):
                h = self._hash(short, b * self.rows)
                for cls in [c for c in self.classes if c[0] == of and b < self.bands_of[c]]:
                    least = _windows(h, cls[1])
                    upper, values = self.first[cls, b]
                    near = np.flatnonzero(upper[least >> np.uint32(16)])
                    step, span = _layout(cls[1])
                    for w in near[np.isin(least[near], values)].tolist():
                        key = self._band(short[w * step : w * step + span], b)
                        asked.update((cls, w, t) for t in self.bucket[cls, b].get(key, ()))
            hits += self._verify(asked, base, first, containment)
        return _merged(hits)

    def _verify(self, asked, base, first, containment):
        out = []
        for cls, w, t in asked:
            step, span = _layout(cls[1])
            lo, hi = w * step, min(len(base), w * step + span)
            # a window laid over the end of a text is read as its parts in each text
            for d in range(int(np.searchsorted(first, lo, "right")) - 1, len(first) - 1):
                if first[d] >= hi:
                    break
                a, b = max(lo, int(first[d])), min(hi, int(first[d + 1]))
                if a < b:
                    i, found = self.classes[cls][t]
                    inside = np.flatnonzero(np.isin(base[a:b], found))
                    share = len(np.unique(base[a:b][inside])) / len(found)
                    if share >= containment:
                        out.append((d, i, int(a + inside[0] - first[d]), int(a + inside[-1] - first[d]) + cls[0], share))
        return out


def _bands_for(size: int, span: int, containment: float, rows: int, miss: float = 0.001) -> int:
    """Bands that meet a template of ``size`` shingles in a window of ``span``
    that holds no more of it than the containment."""
    held = min(size, span, max(1, math.ceil(containment * size - 1e-9)))
    like = held / (span + size - held)
    return 1 if like >= 1 else max(1, math.ceil(math.log(miss) / math.log(1 - like**rows)))


def _short(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(32)).astype("u4")


def _grades():
    g = 1
    while True:
        yield g
        g = max(g + 1, int(g * 1.25))


def _layout(grade: int) -> tuple[int, int]:
    """Distance and length of the windows of a class."""
    step = max(1, grade // 4)
    return step, (-(-grade // step) + 1) * step if grade > 1 else 1


def _windows(h: np.ndarray, grade: int) -> np.ndarray:
    """Least hash of each window, by the least of each step's stretch."""
    step, span = _layout(grade)
    low = np.minimum.reduceat(h, np.arange(0, len(h), step)) if step > 1 else h
    out = low.copy()
    for k in range(1, min(span // step, len(low))):
        out[: len(low) - k] = np.minimum(out[: len(low) - k], low[k:])
    return out


def _merged(hits: list) -> list:
    """One row for a template's overlapping hits in a text."""
    out: list[list] = []
    for d, t, a, b, share in sorted(hits, key=lambda h: (h[0], h[1], h[2], -h[4])):
        if out and out[-1][0] == d and out[-1][1] == t and a < out[-1][3]:
            out[-1][3], out[-1][4] = max(out[-1][3], b), max(out[-1][4], share)
        else:
            out.append([d, t, a, b, share])
    return [tuple(x) for x in out]


def scan_licenses(df: DataFrame, templates: dict[str, str] = NOTICES, id_col: str = "doc_id", text_col: str = "text", bands: int | None = None, rows: int = 1, containment: float = 0.8) -> DataFrame:
    """(id, template, start_word, end_word, containment), one row per match."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    src = id_text(df, id_col, text_col).where("text is not null")
    kind = src.schema[0].dataType.simpleString()
    sent = df.sparkSession.sparkContext.broadcast(Templates(list(templates), list(templates.values()), bands, rows, containment))

    def run(batches):
        found, memo = sent.value, WordHashes()
        for batch in batches:
            for part in slices(batch, SMALL):
                words = [np.array([memo[w] for w in WORDS(t.lower())], "u8") for t in part.column(1).to_pylist()]
                hits = found.scan_many(words, containment)
                if hits:
                    d, t, a, b, share = zip(*hits)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(d)), pa.array([found.names[i] for i in t]), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(share, pa.float64())], ["id", "template", "start_word", "end_word", "containment"])

    out = src.mapInArrow(run, f"id {kind}, template string, start_word int, end_word int, containment double")
    return out.select(F.col("id").alias(id_col), "template", "start_word", "end_word", "containment")
