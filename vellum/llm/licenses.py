"""License scans by a positional index of rare licence words.

Words are lower-cased (A-Z) runs of ASCII digits, letters and characters above U+007F. A first pass counts in how
many texts each licence word stands (a table of bounded size: the words of the templates); a licence word's weight is
its inverse document frequency. Of each template the heaviest words are indexed, as many as an alignment must hold and the heaviest of each key phrase, with their places. In the second pass
a file's words are looked up: a posting gives a relative position (place in the file minus place in the template). Every relative position of the
first key phrase's heaviest word is a candidate, if the positions of enough indexed words lie about it: of a template of n words of which L are
indexed, all but as many as an alignment may lack; with fewer none can hold enough. The stretch of the file from there, DRIFT words longer at either end, is aligned with the template in
order (longest common subsequence of words). A template labels a file if all its mandatory key
phrases stand inside the stretch and the alignment holds MIN_SCORE of its words, and MIN_REST of those beside its key phrases. The base phrases are searched in every text on their own.
Notices of a line are templates that are their own key phrase.

Cases: null and empty texts have no words. Rows that repeat each give a row. An empty table gives an empty result. Very long texts are read whole; every candidate is aligned, none is
capped. Ties: words of equal weight are indexed in alphabetical order, which decides the work, not the result. Other
columns may have any name. Several templates may label one file. score is 1 where a base phrase stands, else the
best aligned share of a candidate (0 without).
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import ship

ship(__name__)

MIN_SCORE = 0.6
#: Share of the words beside the key phrases.
MIN_REST = 0.5
#: Words that a stretch is longer than its template at either end.
DRIFT = 12
#: Base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: (label, text of the notice, mandatory key phrases): short public notices.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", ("permission is hereby granted free of charge",)),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at", ("apache license version 2 0",)),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products", ("redistribution and use in source and binary forms", "neither the name of")),
    ("bsd-2-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice", ("redistribution and use in source and binary forms", "redistributions in binary form")),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version", ("gnu general public license",)),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ("gnu lesser general public license",)),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at", ("mozilla public license",)),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies", ("permission to use copy modify and or distribute this software",)),
    ("unlicense", "This is free and unencumbered software released into the public domain", ("unencumbered software released into the public domain",)),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",)),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", ("waived all copyright and related or neighboring rights",)),
    ("all-rights-reserved", "Copyright All rights reserved", ("all rights reserved",)),
)
#: One-line statements: (label, names that "licensed under" is followed by); each gives templates that are their own key phrases.
STATEMENTS = (
    ("mit", ("MIT License", "MIT Licence", "terms of the MIT License", "Expat License")),
    ("apache-2", ("Apache License 2.0", "Apache License, Version 2.0", "Apache 2.0 License", "terms of the Apache License, Version 2.0")),
    ("bsd-3-clause", ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License")),
    ("bsd-2-clause", ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "FreeBSD License")),
    ("gpl", ("GNU General Public License", "terms of the GNU General Public License", "GNU GPL", "GPL")),
    ("lgpl", ("GNU Lesser General Public License", "terms of the GNU Lesser General Public License", "GNU LGPL", "LGPL")),
    ("mpl-2", ("Mozilla Public License", "terms of the Mozilla Public License", "MPL 2.0")),
    ("isc", ("ISC License", "terms of the ISC License")),
    ("unlicense", ("Unlicense",)),
    ("cc-by-nc", ("Creative Commons Attribution-NonCommercial", "CC BY-NC")),
    ("cc-by-sa", ("Creative Commons Attribution-ShareAlike", "CC BY-SA")),
    ("cc-by", ("Creative Commons Attribution 4.0", "Creative Commons Attribution License", "CC BY 4.0")),
    ("cc0", ("CC0", "Creative Commons Zero", "Creative Commons CC0")),
)
TEMPLATES += tuple((label, text, (text.lower(),)) for label, names in STATEMENTS for name in names for text in (f"under the {name}", f"under {name}", f"under a {name}"))
_CLASS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_CLASS).split()


def find_phrase(words: list[bytes], phrase: list[bytes]) -> list[int]:
    """All starts of phrase in words."""
    out, n, at = [], len(phrase), 0
    while True:
        try:
            at = words.index(phrase[0], at)
        except ValueError:
            return out
        if words[at : at + n] == phrase:
            out.append(at)
        at += 1


class Template:
    """A notice with its key phrases; the words that are indexed and how many of their places a stretch must hold."""

    def __init__(self, label: str, text: str, keys, weights: dict[bytes, float]):
        self.label, self.words, self.keys = label, words_of(text), [words_of(k) for k in keys]
        key = sum(map(len, self.keys))  # the share counts on its own for the words beside the key phrases
        self.needed = max(math.ceil(MIN_SCORE * len(self.words)), key + math.ceil(MIN_REST * (len(self.words) - key)))
        by_weight = sorted(set(self.words), key=lambda w: (-weights.get(w, 0.0), w))
        heaviest = [min(k, key=by_weight.index) for k in self.keys]
        self.indexed = {*by_weight[: self.needed], *heaviest}
        # where the first key phrase's heaviest word stands in the template
        self.anchor = find_phrase(self.words, self.keys[0])[0] + self.keys[0].index(heaviest[0])
        self.floor = max(1, sum(w in self.indexed for w in self.words) - (len(self.words) - self.needed))
        self.masks: dict[bytes, int] = defaultdict(int)
        for place, w in enumerate(self.words):
            self.masks[w] |= 1 << place

    def aligned(self, stretch: list[bytes]) -> int:
        """Length of the longest common subsequence of the template and a stretch of words."""
        full = (1 << len(self.words)) - 1
        rows = full
        for w in stretch:
            if at := self.masks.get(w, 0) & rows:
                rows = (rows + at | rows - at) & full
        return len(self.words) - rows.bit_count()


class LicenseIndex:
    """Postings of the templates' heaviest words, by the weights that the corpus gives them."""

    def __init__(self, weights: dict[str, float], templates=TEMPLATES, base=None):
        self.weights = {w.encode(): v for w, v in weights.items()}
        self.base = [(words_of(p), label) for p, label in (BASE if base is None else base).items()]
        self.templates = [Template(*t, self.weights) for t in templates]
        self.vocabulary = frozenset(w for t in self.templates for w in t.words)
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for k, t in enumerate(self.templates):
            for place, w in enumerate(t.words):
                if w in t.indexed:
                    self.postings[w].append((k, place))

    def base_hits(self, words: list[bytes], present: set[bytes]) -> list[tuple[int, str]]:
        return [(at, label) for phrase, label in self.base if present.issuperset(phrase) for at in find_phrase(words, phrase)]

    def candidates(self, words: list[bytes], present: set[bytes]) -> Iterator[tuple[Template, int]]:
        """(template, relative position) of every place that may be a notice: its key phrase's heaviest word stands there, and enough of the
        indexed words about it."""
        possible = {k for k, t in enumerate(self.templates) if all(present.issuperset(x) for x in t.keys)}
        wanted = {w: own for w in present & self.postings.keys() if (own := [p for p in self.postings[w] if p[0] in possible])}
        votes: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for at, w in enumerate(words):
            for k, place in wanted.get(w, ()):
                votes[k].append((at - place, place))
        for k, held in votes.items():
            t = self.templates[k]
            held.sort()
            starts = [s for s, _ in held]
            reach = len(t.words) + DRIFT
            for s in sorted({s for s, place in held if place == t.anchor}):
                low, high = bisect_left(starts, s - reach), bisect_right(starts, s + reach)
                if high - low >= t.floor and len({place for _, place in held[low:high]}) >= t.floor:
                    yield t, s

    def method_labels(self, words: list[bytes], present: set[bytes]) -> tuple[set[str], float]:
        """(labels, best aligned share) of the templates."""
        labels, best, places = set(), 0.0, {}
        for t, s in self.candidates(words, present):
            low, high = max(0, s - DRIFT), s + len(t.words) + DRIFT
            common = t.aligned(words[low:high])
            best = max(best, common / len(t.words))
            if common < t.needed:
                continue
            for phrase in t.keys:
                key = b" ".join(phrase)
                if key not in places:
                    places[key] = find_phrase(words, phrase)
                i = bisect_left(places[key], low)
                if i == len(places[key]) or places[key][i] + len(phrase) > high:
                    break
            else:
                labels.add(t.label)
        return labels, best


def _present(index: LicenseIndex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        n = 0
        for batch in batches:
            for t in batch.column(0):
                counts.update(index.vocabulary.intersection(words_of(t.as_py())))
                n += 1
        names = list(counts)
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in names] + [None], pa.string()), pa.array([counts[w] for w in names] + [n], pa.int64())], names=["word", "n"])

    return run


def licence_weights(docs: DataFrame) -> dict[str, float]:
    """Inverse document frequency over all texts of the templates' words (a bounded vocabulary)."""
    index = LicenseIndex({})
    counts = docs.select(F.col("text").cast("string")).mapInArrow(_present(index), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    n = sum(r.n for r in counts if r.word is None)
    seen = {r.word: r.n for r in counts if r.word is not None}
    return {w.decode(): math.log((n + 1) / (seen.get(w.decode(), 0) + 1)) for w in index.vocabulary}


SCAN = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def _scan(index: LicenseIndex):
    def one(text: str | None) -> tuple:
        words = words_of(text)
        present = set(words)
        hits = index.base_hits(words, present)
        labels, score = index.method_labels(words, present)
        base = {label for _, label in hits}
        places = [at for at, _ in hits]
        return len(words), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if hits else score

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
        for batch in batches:
            rows = [one(t.as_py()) for t in batch.column(1)]
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[c.split()[0] for c in SCAN.split(", ")])

    return run


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row of docs."""
    index = LicenseIndex(licence_weights(docs))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_scan(index), SCAN)


def op3_licenses(spark, sf_dir: str) -> DataFrame:
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
