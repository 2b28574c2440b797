"""License scan: MinHash bands over overlapping windows, then exact containment.

Texts and templates are taken as sequences of lower-cased runs of letters and
digits, and as shingles of WIDTH of them. Templates are classed by their number
of shingles, up to a power of two. A class of up to L shingles is looked for in
windows of 2 L shingles that start every L, so every occurrence of a template
lies whole in some window. A template of which a share t is in the window has a
Jaccard similarity with it of at least t m / ((1 - t) m + 2 L), m the smallest
size of the class; ``bands_for`` gives the number of one-row MinHash bands at
which such a template is retrieved with probability GUARANTEE. What is retrieved
is verified: the share of the template's shingles in the window, by exact
counting of 64-bit shingles.

A window with fewer shingles of a class than its smallest template needs cannot
verify and is not hashed, which leaves out nothing. Templates are a parameter: a
bounded table, broadcast. Without it the scan takes NOTICES and the texts and
headers of ``spdx``, and reads short notices by the rule there: a notice of a few
words has too few shingles for a share of them to mean anything. Every text is
read whole.

Many licenses share most of their words, so of matches in one place the one stays
that explains most of it: found less missing shingles of its template.

Defined results: null and empty texts have no matches; overlapping windows that
find one occurrence give one row, with the larger share; a short notice read by
the rule has the share 1; other occurrences give rows of their own; repeated
rows give their matches each; a null id is kept; extra columns are not read."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from priceloom.llm import spdx
from priceloom.llm.common import text_of
from priceloom.llm.quality import KIND
from priceloom.llm.text import LOWER, hash_runs, joined_bytes, mix, runs, shingles, slices

WIDTH, CONTAINMENT, GUARANTEE = 5, 0.8, 0.9999

# The first four are the license lines of the test tables, the others are from
# license texts and headers. ``spdx.texts`` adds more of those.
NOTICES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software."
    ),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD-2-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied."
    ),
    "GPL-3.0-or-later-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means."
    ),
}


def bands_for(similarity: float, probability: float, rows: int = 1) -> int:
    """The bands at which sets of this similarity share one with at least this
    probability."""
    return math.ceil(math.log(1 - probability) / math.log(1 - similarity**rows))


def _shingled(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, tuple]:
    data, offsets = joined_bytes(texts)
    starts, ends, first = runs(KIND[data] == 1, offsets)
    values, begins = shingles(hash_runs(LOWER[data], starts, ends), first, WIDTH)
    return values, begins, (data, offsets, starts, ends, first)


class _Words:
    """The lower-cased words of a text, decoded where they are asked for."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.data, self.starts, self.ends = data, starts, ends

    def __getitem__(self, which: slice) -> list[str]:
        spans = zip(self.starts[which].tolist(), self.ends[which].tolist())
        return [LOWER[self.data[a:b]].tobytes().decode("utf-8", "replace") for a, b in spans]


class Templates:
    def __init__(self, texts: Mapping[str, str], containment: float = CONTAINMENT):
        self.names, self.containment = list(texts), containment
        values, begins, _ = _shingled(pa.array(list(texts.values()), pa.string()))
        self.sets = [np.unique(values[a:b]) for a, b in zip(begins, begins[1:])]
        self.lengths = np.diff(begins).tolist()
        self.all = np.unique(values)
        self.kinds = np.zeros(len(self.all), dtype=np.int64)
        self.classes: dict[int, int] = {}
        self.needed: dict[int, int] = {}
        self.bands: dict[int, list[dict[int, list[int]]]] = {}
        members = defaultdict(list)
        for i, length in enumerate(self.lengths):
            members[1 << (length - 1).bit_length()].append(i)
        for number, (size, which) in enumerate(members.items()):
            for i in which:
                self.kinds[np.searchsorted(self.all, self.sets[i])] |= 1 << number
            least = min(len(self.sets[i]) for i in which)
            floor = containment * least / ((1 - containment) * least + 2 * size)
            self.classes[size] = bands_for(floor, GUARANTEE)
            self.needed[size] = max(1, int(containment * least))
            tables: list[dict[int, list[int]]] = [defaultdict(list) for _ in range(self.classes[size])]
            for i in which:
                for table, low in zip(tables, self.signature(self.sets[i], len(tables)).tolist()):
                    table[low].append(i)
            self.bands[size] = [dict(t) for t in tables]

    @staticmethod
    def signature(tokens: np.ndarray, bands: int) -> np.ndarray:
        seeds = mix(np.arange(1, bands + 1, dtype=np.uint64))
        return mix(tokens[None, :] ^ seeds[:, None]).min(axis=1)

    def occurrences(self, i: int, window: np.ndarray, share: float) -> Iterator[tuple[int, int, float]]:
        """First and last place and share of each occurrence of a template that
        the window holds: runs as long as the template, grown while that adds
        shingles of it. Without such a run, all its places are one occurrence."""
        places = np.flatnonzero(np.isin(window, self.sets[i]))
        reach, whole, none = self.lengths[i], len(self.sets[i]), True
        todo = [places]
        while todo:
            at = todo.pop()
            if len(at) < self.containment * whole:
                continue
            ends = np.searchsorted(at, at + reach)
            low = int(np.argmax(ends - np.arange(len(at))))
            high = int(ends[low])
            seen = set(window[at[low:high]].tolist())
            if len(seen) < self.containment * whole:
                continue
            gap = reach // 4 + WIDTH
            while high < len(at) and at[high] - at[high - 1] <= gap and (token := int(window[at[high]])) not in seen:
                seen.add(token)
                high += 1
            while low and at[low] - at[low - 1] <= gap and (token := int(window[at[low - 1]])) not in seen:
                seen.add(token)
                low -= 1
            none = False
            yield int(at[low]), int(at[high - 1]), len(seen) / whole
            todo += [at[:low], at[high:]]
        if none:
            yield int(places[0]), int(places[-1]), share

    def matches(self, tokens: np.ndarray, hits: np.ndarray, kinds: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(template, first shingle, last shingle, share) in one text; hits are
        the places of its shingles that occur in some template, kinds the classes
        of those as bits."""
        found: dict[int, list[tuple[int, int, float]]] = defaultdict(list)
        for bit, (size, bands) in enumerate(self.classes.items()):
            own = hits[(kinds >> bit) & 1 == 1]
            if len(own) < self.needed[size]:
                continue
            last = own // size
            numbers = np.unique(np.concatenate([last, last[last > 0] - 1]))
            held = np.searchsorted(own, (numbers + 2) * size) - np.searchsorted(own, numbers * size)
            for number in numbers[held >= self.needed[size]].tolist():
                whole = tokens[number * size : (number + 2) * size]
                window = np.unique(whole)
                lows = self.signature(window, bands).tolist()
                near = {i for table, low in zip(self.bands[size], lows) for i in table.get(low, ())}
                for i in sorted(near):
                    share = np.isin(self.sets[i], window, assume_unique=True).mean()
                    if share >= self.containment:
                        spans = self.occurrences(i, whole, float(share))
                        found[i] += [(number * size + a, number * size + b, part) for a, b, part in spans]
        out = []
        for i, spans in sorted(found.items()):
            apart: list[tuple[int, int, float]] = []
            # an occurrence is whole in some window, and there its share is largest
            for span in sorted(set(spans), key=lambda m: (-m[2], m[1] - m[0], m[0])):
                if all(span[1] < m[0] or m[1] < span[0] for m in apart):
                    apart.append(span)
            out += [(i, *m) for m in sorted(apart)]
        return out


def settled(found: list[tuple[str, int, int, float, float, bool]]) -> list[tuple[str, int, int, float]]:
    """Of matches (name, first word, last word, share, weight, compact) in one
    place, the one of the largest weight. Two are in one place if half of the
    shorter one is common to them. One that is spread over more words than its
    template has drops no other."""
    kept: list[tuple[str, int, int, float, float, bool]] = []
    for one in sorted(found, key=lambda m: (-m[4], m[1], m[0])):
        _, first, last, *_ = one
        common = [(min(last, k[2]) - max(first, k[1]) + 1, min(last - first, k[2] - k[1]) + 1) for k in kept if k[5] or k[0] == one[0]]
        if not any(2 * both >= shorter for both, shorter in common):
            kept.append(one)
    return sorted(k[:4] for k in kept)


def scan(docs: DataFrame, templates: Mapping[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, license, start, end (code points, end exclusive) and containment
    of every match: of the given templates, or of all known licenses."""
    notices = docs.sparkSession.sparkContext.broadcast(dict(templates or NOTICES | spdx.texts()))
    short = not templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(notices.value, containment)
        _, _, (anchors, _, at, to, _) = _shingled(pa.array([" ".join(spdx.ANCHORS)], pa.string()))
        anchors = np.unique(hash_runs(LOWER[anchors], at, to))
        for part in slices(batches, "text"):
            values, begins, (data, offsets, starts, ends, first) = _shingled(part.column("text"))
            at = np.minimum(np.searchsorted(known.all, values), len(known.all) - 1)
            hits = np.flatnonzero(known.all[at] == values)
            owner = np.searchsorted(begins, hits, side="right") - 1
            matches: dict[int, list[tuple]] = defaultdict(list)
            for i in np.unique(owner).tolist():
                mine = hits[slice(*np.searchsorted(owner, [i, i + 1]))]
                kinds = known.kinds[at[mine]]
                for which, low, high, share in known.matches(values[begins[i] : begins[i + 1]], mine - begins[i], kinds):
                    last = int(min(first[i] + high + WIDTH, first[i + 1]) - 1 - first[i])
                    size = len(known.sets[which])
                    compact = last - low < 1.5 * (known.lengths[which] + WIDTH)
                    matches[i].append((known.names[which], low, last, share, size * (2 * share - 1), compact))
            if short:
                named = np.flatnonzero(np.isin(hash_runs(LOWER[data], starts, ends), anchors))
                owner = np.searchsorted(first, named, side="right") - 1
                for i in np.unique(owner).tolist():
                    mine = named[slice(*np.searchsorted(owner, [i, i + 1]))] - first[i]
                    for low, last, name in spdx.names_at(_Words(data, starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]]), mine.tolist()):
                        matches[i].append((name, low, last, 1.0, 0.5, True))
            rows: list[tuple] = []
            for i, found in sorted(matches.items()):
                letters = np.cumsum((data[offsets[i] : offsets[i + 1]] & 0xC0) != 0x80)
                for name, low, last, share in settled(found):
                    a, b = starts[first[i] + low] - offsets[i], ends[first[i] + last] - offsets[i]
                    rows.append((i, name, int(letters[a]) - 1, int(letters[b - 1]), share))
            index, names, lows, highs, shares = zip(*rows) if rows else ((), (), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(index, pa.int64())),
                    pa.array(names, pa.string()),
                    pa.array(lows, pa.int64()),
                    pa.array(highs, pa.int64()),
                    pa.array(shares, pa.float64()),
                ],
                ["doc_id", "license", "start", "end", "containment"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id long, license string, start long, end long, containment double")
