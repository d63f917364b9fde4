"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

The units compared are stretches of terms of a template's length, laid so that a decisive term of the file falls on the
same term of the template; line breaks and what stands before or behind do not matter. A template's vector covers its
own terms; document frequencies of these terms are counted over all lines of all files, and any other term of a unit
weighs as one that was never seen. Decisive terms are those that are left when terms whose weights cannot reach the
threshold together are taken away, the most frequent ones first: a unit with none of them matches nothing
(Cauchy-Schwarz).

A unit speaks for the licence of its best template if all of this holds, and for none otherwise:
the cosine, rounded to twelve digits, reaches the threshold; no template of another licence comes within the margin;
of the template's terms that no other licence's templates have, by weight, at least half is there (the name, mostly);
of the terms that tell the template from each similar template of another licence, a greater part is there than of those
that tell the other one (a version number, "noncommercial", "lesser"); no negation stands in it that the
template lacks, nor in the four terms before it in its sentence. A file has the licence of its best unit (ties: the
greater name), where a licence that includes another one's terms goes first. Files whose matching units make up enough
of the text, or hold the title of a licence, are licence files and speak for their directory; a file without a licence
of its own takes that of the nearest ancestor directory that has one.

Null and empty texts match nothing; a null path is a file of no directory and inherits nothing. Repeated files are
judged each by itself. If several licence files share a directory, the highest score decides, then the smallest path.
Of a text of any length, places of terms are held while it is judged. Extra columns pass through ``scan``.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_GNU = "you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
_CREATIVE = {
    "CC-BY": "Attribution", "CC-BY-SA": "Attribution-ShareAlike", "CC-BY-ND": "Attribution-NoDerivatives", "CC-BY-NC": "Attribution-NonCommercial",
    "CC-BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "CC-BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
#: Notices and opening sentences of public licences.
TEMPLATES = [
    ("AGPL-3.0", "This program is free software: " + _GNU.format("Affero General Public License", "3")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC0-1.0", "This work is licensed under CC0 1.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; " + _GNU.format("General Public License", "2")),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: " + _GNU.format("General Public License", "3")),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "This library is free software; " + _GNU.format("Lesser General Public License", "2.1")),
    ("LGPL-3.0", "This library is free software: " + _GNU.format("Lesser General Public License", "3")),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    *[(f"{code}-4.0", f"Licensed under {code.replace('-', ' ', 1)} 4.0.") for code in _CREATIVE],
    *[(f"{code}-4.0", f"This work is licensed under a Creative Commons {words} 4.0 International License.") for code, words in _CREATIVE.items()],
]
TEMPLATES += [(name, f"SPDX-License-Identifier: {name}{suffix}") for name in sorted({n for n, _ in TEMPLATES}) for suffix in (("", "-only", "-or-later") if "GPL" in name else ("",))]
#: Titles that head the full texts of licences.
TITLES = [
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
]
#: Licences whose text holds that of another one.
INCLUDES = {"BSD-3-Clause": "BSD-2-Clause"}
NEGATIONS = frozenset(("not", "never", "no", "neither", "nor", "isn", "wasn", "aren"))
#: Terms before a unit in which a negation counts.
BEFORE = 4
#: Cosine from which two templates are similar, so that their differences decide.
SIMILAR = 0.5
_TERM = re.compile(r"[a-z0-9]+(?:\.[a-z0-9]+)*")
_SENTENCE_END = re.compile(r"[.!?;:]\s|\n[^\S\n]*\n")


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


class Matcher:
    """Template vectors under given document frequencies; ``titles`` are templates too."""

    def __init__(self, templates: list[tuple[str, str]], units: int, df: dict[str, int], threshold: float, titles: list[tuple[str, str]] = (), margin: float = 0.005):
        self.n_notices, templates = len(templates), [*templates, *titles]
        self.threshold, self.margin, self.unseen = threshold, margin, math.log(1 + units) + 1
        self.words = [(name, terms(text)) for name, text in templates]
        self.idf = {t: math.log((1 + units) / (1 + df.get(t, 0))) + 1 for _, x in self.words for t in x}
        self.vectors = []
        for name, x in self.words:
            vector = {t: n * self.idf[t] for t, n in Counter(x).items()}
            self.vectors.append((name, vector, math.sqrt(sum(w * w for w in vector.values()))))
        self.decisive = frozenset(self._decisive())
        self.places: dict[str, list[tuple[int, int]]] = {}  # where a decisive term stands in templates: offset, length
        self.of: dict[str, list[tuple[int, float]]] = {}
        for i, (_, x) in enumerate(self.words):
            for offset, t in enumerate(x):
                if t in self.decisive and (offset, len(x)) not in self.places.setdefault(t, []):
                    self.places[t].append((offset, len(x)))
            for t, w in self.vectors[i][1].items():
                self.of.setdefault(t, []).append((i, w * self.idf[t] / self.vectors[i][2]))
        self.foreign = {name: frozenset(t for other, x in self.words if other != name for t in x) for name, _ in self.words}
        self.siblings = [[j for j, (other, _, _) in enumerate(self.vectors) if other != name and self._similar(i, j)] for i, (name, _, _) in enumerate(self.vectors)]

    def _decisive(self) -> list[str]:
        weak: set[str] = set()
        for t in sorted(self.idf, key=lambda t: (self.idf[t], t)):
            trial = weak | {t}
            if all(sum(w * w for u, w in v.items() if u in trial) < (self.threshold * norm) ** 2 * 0.999 for _, v, norm in self.vectors):
                weak = trial
        return sorted(set(self.idf) - weak)

    def _similar(self, i: int, j: int) -> bool:
        (_, a, m), (_, b, n) = self.vectors[i], self.vectors[j]
        return sum(w * b[t] for t, w in a.items() if t in b) >= SIMILAR * m * n

    def _share(self, unit: Counter, i: int, others: frozenset[str] | dict[str, float]) -> float:
        """How much of what template ``i`` has and ``others`` have not is in the unit, by weight; a half if there is no such term."""
        own = {t: self.idf[t] ** 2 for t in self.vectors[i][1] if t not in others}
        return sum(w for t, w in own.items() if t in unit) / sum(own.values()) if own else 0.5

    def judge(self, unit: list[str]) -> tuple[float, str, bool] | None:
        """Cosine, licence and whether it is a title, if the unit speaks for a licence."""
        counts, dots = Counter(unit), [0.0] * len(self.vectors)
        for t, n in counts.items():
            for i, x in self.of.get(t, ()):
                dots[i] += n * x
        norm = math.sqrt(sum((n * self.idf.get(t, self.unseen)) ** 2 for t, n in counts.items()))
        best = max(range(len(dots)), key=lambda i: (dots[i], -i))
        score, name = round(dots[best] / norm, 12), self.vectors[best][0]
        if score < self.threshold or any(d / norm > score - self.margin and other != name for d, (other, _, _) in zip(dots, self.vectors, strict=True)):
            return None
        if any(t in NEGATIONS and t not in self.vectors[best][1] for t in counts):
            return None
        if self._share(counts, best, self.foreign[name]) < 0.5:
            return None
        vector = self.vectors[best][1]
        if any(self._share(counts, best, self.vectors[j][1]) <= self._share(counts, j, vector) for j in self.siblings[best]):
            return None
        return score, name, best >= self.n_notices

    def scan(self, text: str | None) -> tuple[str | None, float | None, float | None]:
        """Licence, cosine and share of the file's terms in matching units; nulls without a match. A title stands for the whole file."""
        low = (text or "").lower()
        if not any(t in low for t in self.decisive) or all(self.decisive.isdisjoint(_TERM.findall(line)) for line in low.split("\n")):
            return None, None, None
        starts, ends, units = array("q"), array("q"), set()
        anchors = []
        for i, m in enumerate(_TERM.finditer(low)):
            starts.append(m.start())
            ends.append(m.end())
            if m.group() in self.decisive:
                anchors.append(i)
        for i in anchors:
            for offset, n in self.places[low[starts[i] : ends[i]]]:
                units.add((max(0, i - offset), min(len(starts), i - offset + n)))
        best: dict[str, float] = {}
        covered, titled = set(), False
        for first, end in sorted(units):
            found = self.judge([low[starts[k] : ends[k]] for k in range(first, end)])
            if found is None or self._negated(low, starts, ends, first):
                continue
            best[found[1]] = max(found[0], best.get(found[1], 0.0))
            covered.update(range(first, end))
            titled = titled or found[2]
        if not best:
            return None, None, None
        for wider, narrower in INCLUDES.items():
            if wider in best:
                best.pop(narrower, None)
        score, name = max((x, n) for n, x in best.items())
        return name, score, 1.0 if titled else len(covered) / len(starts)

    @staticmethod
    def _negated(low: str, starts: array, ends: array, first: int) -> bool:
        """Whether a negation stands shortly before the unit, in the sentence that it begins in."""
        for k in range(first - 1, max(-1, first - 1 - BEFORE), -1):
            if _SENTENCE_END.search(low, ends[k], starts[k + 1]):
                return False
            if low[starts[k] : ends[k]] in NEGATIONS:
                return True
        return False


def line_frequencies(files: DataFrame, templates: list[tuple[str, str]], text: str = "text") -> tuple[int, dict[str, int]]:
    """Number of lines of all files, and in how many each template term occurs: one count per term leaves a task."""
    known = frozenset(t for _, x in templates for t in terms(x))

    def run(batches):
        found, lines = Counter(), 0
        for batch in batches:
            for x in batch.column(0):
                for line in (x.as_py() or "").lower().split("\n"):
                    lines += 1
                    found.update(known.intersection(_TERM.findall(line)))
        yield pa.RecordBatch.from_arrays([pa.array(["", *found], pa.string()), pa.array([lines, *found.values()], pa.int64())], names=["term", "n"])

    counts = files.select(F.col(text)).mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = {r["term"]: r["n"] for r in counts.collect()}  # at most one row per template term
    return df.pop("", 0), df


def scan(files: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = 0.8, text: str = "text", titles: list[tuple[str, str]] | None = None) -> DataFrame:
    """``files`` with own_license, score and share of each file's own text; existing columns of these names are replaced."""
    files = files.drop("own_license", "score", "share", "_found")
    templates, titles = TEMPLATES if templates is None else templates, TITLES if titles is None else titles
    units, df = line_frequencies(files, [*templates, *titles], text)
    matcher = Matcher(templates, units, df, threshold, titles)

    @F.arrow_udf("own_license string, score double, share double")
    def run(texts: pa.Array) -> pa.Array:
        found = [matcher.scan(x.as_py()) for x in texts]
        return pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.float64())], names=["own_license", "score", "share"])

    return files.withColumn("_found", run(F.col(text))).select("*", "_found.*").drop("_found")


def inherit(scanned: DataFrame, file_share: float = 0.1) -> DataFrame:
    """path, own_license, score, share, license, origin (own, inherited or null) and from_dir. ``scanned``: path and the columns of ``scan``.

    ``scanned`` is read several times, so it should be a written table. Ancestors are listed once per directory, not
    per file; the joins are on paths.
    """
    directory = F.when(F.contains("path", F.lit("/")), F.regexp_replace("path", "/[^/]*$", "")).when(F.col("path").isNotNull(), F.lit(""))
    files = scanned.withColumn("dir", directory)
    speaks = files.where(F.col("own_license").isNotNull() & (F.col("share") >= file_share) & F.col("dir").isNotNull())
    best = F.min(F.struct((-F.col("score")).alias("s"), "path", "own_license"))
    licensed = speaks.groupBy("dir").agg(best.alias("b")).select(F.col("dir").alias("from_dir"), F.col("b.own_license").alias("dir_license"))
    parts = F.split("dir", "/")
    above = F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")))
    dirs = files.where("dir is not null").select("dir").distinct().withColumn("from_dir", F.explode(F.array_distinct(above)))
    nearest = dirs.join(licensed, "from_dir").groupBy("dir").agg(F.max(F.struct(F.length("from_dir").alias("n"), "from_dir", "dir_license")).alias("b")).select("dir", "b.from_dir", "b.dir_license")
    out = files.join(nearest, "dir", "left")
    own = F.col("own_license").isNotNull()
    return out.withColumns({"license": F.coalesce("own_license", "dir_license"), "origin": F.when(own, "own").when(F.col("dir_license").isNotNull(), "inherited"), "from_dir": F.when(~own, F.col("from_dir"))}).drop("dir", "dir_license")
