"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies.

A text's words are cut into overlapping windows of a few sizes. Each window has a MinHash
signature of its word shingles, split into bands; a band that equals one of a template of about that
size makes the template a candidate there. It is reported if the window and its surroundings hold
enough of the template's shingles. With BANDS bands of ROWS rows a window of similarity s meets its template
with probability 1 - (1 - s ** ROWS) ** BANDS: 0.99 at one half, 0.9999 at two thirds, 1 for an exact copy.
Templates longer than the longest window are cut into overlapping windows as texts are, each with bands of its
own. A window that meets one of them tells where the whole template would lie, and there all of it is verified.
"""

from __future__ import annotations

import pkgutil
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import in_slices, ship_package
from tramline.llm.shingles import mixed, run_hashes, word_hashes

WORDS = 3
BANDS = 16
ROWS = 2
CONTAINED = 0.8
# Windows are this many words long and begin every quarter of that.
SIZES = (5, 8, 13, 21, 34, 55, 89, 144)
CHARS_AT_ONCE = 1 << 20

_GNU = (
    "is free software{0} you can redistribute it and/or modify it under the terms of the GNU {1}General Public License "
    "as published by the Free Software Foundation{2} either version {3} of the License, or (at your option) any later version."
)
_CC_OPENING = (
    "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of "
    "this Creative Commons {0} 4.0 International Public License"
)

# Notices by which licenses are commonly named or granted, with the license each names.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    ("GPL-2.0", "This program " + _GNU.format(";", "", ";", "2")),
    ("LGPL-2.0", "This library " + _GNU.format(";", "Library ", ";", "2")),
    ("LGPL-2.1", "This library " + _GNU.format(";", "Lesser ", ";", "2.1")),
    ("LGPL-3.0", "This library " + _GNU.format(":", "Lesser ", ",", "3")),
    ("AGPL-3.0", "This program " + _GNU.format(":", "Affero ", ",", "3")),
    (
        "AGPL-3.0",
        "Notwithstanding any other provision of this License, if you modify the Program, your modified version must "
        "prominently offer all users interacting with it remotely through a computer network (if your version supports "
        "such interaction) an opportunity to receive the Corresponding Source of your version by providing access to the "
        "Corresponding Source from a network server at no charge, through some standard or customary means of "
        "facilitating copying of software.",
    ),
    ("CC-BY-4.0", _CC_OPENING.format("Attribution")),
    ("CC-BY-SA-4.0", _CC_OPENING.format("Attribution-ShareAlike")),
    ("CC-BY-NC-4.0", _CC_OPENING.format("Attribution-NonCommercial")),
    (
        "CC0-1.0",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights "
        "to this software to the public domain worldwide.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "EPL-1.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "v1.0 which accompanies this distribution",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at",
    ),
)
# Full texts, in license_texts/.
FULL_TEXTS = (
    "Apache-2.0", "Artistic-1.0", "BSD", "CC-BY-SA-4.0", "CC0-1.0", "EPL-1.0", "GFDL-1.3", "GPL-2.0", "GPL-3.0", "ISC",
    "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-1.1", "MPL-2.0", "Unlicense", "Zlib",
)
# Full texts that are mostly contained in another license's, which a notice inside tells.
TOLD_BY = {"GPL-3.0": ("AGPL-3.0",), "CC-BY-SA-4.0": ("CC-BY-4.0", "CC-BY-NC-4.0")}


def full_text(name: str) -> str:
    return pkgutil.get_data("tramline.llm", f"license_texts/{name}.txt").decode()


TEMPLATES = (*NOTICES, *((name, full_text(name)) for name in FULL_TEXTS))

_WORD_BYTES = bytes(b if chr(b).isalnum() and b < 128 else 32 for b in range(256))
_SEEDS = np.random.default_rng(20240602).integers(1, 1 << 62, BANDS * ROWS, np.uint64) | np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """BANDS band hashes of a set of shingle hashes."""
    least = mixed(shingles[:, None] * _SEEDS[None, :] + _SEEDS[None, ::-1]).min(axis=0).reshape(BANDS, ROWS)
    bands = np.zeros(BANDS, np.uint64)
    for row in range(ROWS):
        bands = mixed(bands + least[:, row])
    return bands


def _steps(size: int) -> int:
    return max(1, size // 4)


class Templates:
    """The templates' shingles, and their bands by window size."""

    def __init__(self, templates: tuple[tuple[str, str], ...]):
        self.names, self.sets, self.sizes = [], [], []
        # Which templates have a band there, and how many words into the template that window begins.
        self.bands: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
        known: dict[int, list[np.ndarray]] = {}
        for name, text in templates:
            hashes, _ = word_hashes([text], _WORD_BYTES)
            runs = run_hashes(hashes, WORDS)
            shingles = np.unique(runs)
            size = next((s for s in SIZES if s >= len(hashes)), SIZES[-1])
            # The last window of a long template ends with it.
            starts = sorted({*range(0, len(hashes) - size, _steps(size)), max(0, len(hashes) - size)})
            for start in starts:
                for band, value in enumerate(signature(runs[start : start + size - WORDS + 1]).tolist()):
                    self.bands.setdefault((size, band, value), []).append((len(self.names), start))
            known.setdefault(size, []).append(shingles)
            self.names.append(name)
            self.sets.append(shingles)
            self.sizes.append(max(size, len(hashes)))
        self.all = {size: np.unique(np.concatenate(sets)) for size, sets in known.items()}
        # Notices, or full texts, of two licenses with much the same wording.
        self.rivals = [
            [
                other
                for other in range(len(self.names))
                if self.names[one] != self.names[other]
                and self._is_long(one) == self._is_long(other)
                and 2 * len(np.intersect1d(self.sets[one], self.sets[other])) >= min(len(self.sets[one]), len(self.sets[other]))
            ]
            for one in range(len(self.names))
        ]

    def _is_long(self, template: int) -> bool:
        return self.sizes[template] > SIZES[-1]

    def found(self, shingles: np.ndarray) -> list[tuple[str, int, int, float]]:
        """(name, first word, end, containment) in a text, given the shingle at each of its words."""
        if not len(shingles):
            return []
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        seen: set[tuple[int, int]] = set()
        for size, known in sorted(self.all.items()):
            # A window without any template's shingle cannot share a band with one.
            at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
            hits = np.flatnonzero(known[at] == shingles)
            step = _steps(size)
            last = hits // step
            first = np.maximum(0, -(-(hits - size + WORDS) // step))
            windows = {w for f, u in zip(first.tolist(), last.tolist()) for w in range(f, u + 1)}
            for window in sorted(windows):
                start = window * step
                held = shingles[start : start + size - WORDS + 1]
                if not len(held):
                    continue
                bands = signature(held).tolist()
                met = {t for band, value in enumerate(bands) for t in self.bands.get((size, band, value), ())}
                for template, offset in met:
                    if not self._is_long(template):
                        self._verify(template, shingles, max(0, start - size // 2), start + size + size // 2, best)
                        continue
                    # Windows that place the template at about the same word are verified once.
                    whole = self.sizes[template]
                    quarter = whole // 4
                    place = (start - offset) // quarter
                    if (template, place) not in seen:
                        seen.add((template, place))
                        low, high = place * quarter - whole // 2, (place + 1) * quarter + whole + whole // 2
                        self._verify_long(template, shingles, max(0, low), high, best)
        # Of overlapping finds of rivals the fullest stay.
        places: dict[int, list[tuple[float, int, int]]] = {}
        for (template, start), (contained, _, end) in best.items():
            places.setdefault(template, []).append((contained, start, end))
        ranked = []
        for (template, start), (contained, _, end) in best.items():
            against = (place for rival in self.rivals[template] for place in places.get(rival, ()))
            if not any(c > contained and e > start and s < end for c, s, e in against):
                ranked.append((not self._is_long(template), -contained, start, -end, self.names[template]))
        # Of overlapping finds of one license full texts come first, then the fullest, then the first and longest.
        kept: list[tuple[str, int, int, float]] = []
        notices = [(name, start, -end) for short, _, start, end, name in ranked if short]
        for short, contained, start, end, name in sorted(ranked):
            told = not short and any(
                n in TOLD_BY.get(name, ()) and -end > s and start < e for n, s, e in notices
            )
            if not told and all(name != n or -end <= s or start >= e for n, s, e, _ in kept):
                kept.append((name, start, -end, -contained))
        return sorted(kept)

    def _verify(self, template: int, shingles: np.ndarray, low: int, high: int, best: dict) -> None:
        wanted = self.sets[template]
        near = shingles[low:high]
        inside = np.flatnonzero(np.isin(near, wanted))
        contained = len(np.unique(near[inside])) / len(wanted)
        if contained >= CONTAINED:
            start, end = low + int(inside[0]), low + int(inside[-1]) + WORDS
            best[template, start] = max(best.get((template, start), (0.0, 0, 0)), (contained, start, end))

    def _verify_long(self, template: int, shingles: np.ndarray, low: int, high: int, best: dict) -> None:
        """As _verify, in the shortest of the fullest stretches that are at most a quarter longer than the template."""
        wanted = self.sets[template]
        near = shingles[low:high]
        inside = np.flatnonzero(np.isin(near, wanted))
        if len(np.unique(near[inside])) < CONTAINED * len(wanted):
            return
        longest = self.sizes[template] * 5 // 4
        places, values = inside.tolist(), near[inside].tolist()
        held: dict[int, int] = {}
        fullest, first = (0, 0, 0), 0
        for at, (place, value) in enumerate(zip(places, values)):
            held[value] = held.get(value, 0) + 1
            # What is too far back goes, and what occurs again later.
            while place - places[first] + WORDS > longest or held[values[first]] > 1:
                held[values[first]] -= 1
                if not held[values[first]]:
                    del held[values[first]]
                first += 1
            fullest = max(fullest, (len(held), places[first] - place, -places[first]))
        count, length, start = fullest
        if count >= CONTAINED * len(wanted):
            start = low - start
            best[template, start] = (count / len(wanted), start, start - length + WORDS)


@lru_cache(maxsize=4)
def _prepared(templates: tuple[tuple[str, str], ...]) -> Templates:
    return Templates(templates)


_FOUND = "doc_id long, found array<struct<license:string,start:long,end:long,containment:double>>"


def scan_licenses(documents: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """`doc_id, found` of every row with `doc_id` and `text`: the notices in it by license and place.

    Words are runs of ASCII letters and digits in any case; places are word numbers, `end` exclusive. Null and
    empty texts have none. Rows that repeat a doc_id are scanned one by one.
    """
    ship_package(documents.sparkSession)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _prepared(templates)
        for batch in in_slices(batches):
            texts = batch.column("text").to_pylist()
            found, at = [], 0
            while at < len(texts):
                upto, chars = at + 1, len(texts[at])
                while upto < len(texts) and chars + len(texts[upto]) <= CHARS_AT_ONCE:
                    chars += len(texts[upto])
                    upto += 1
                hashes, begins = word_hashes(texts[at:upto], _WORD_BYTES)
                runs = run_hashes(hashes, WORDS)
                for first, last in zip(begins[:-1], begins[1:]):
                    found.append(known.found(runs[first : max(first, last - WORDS + 1)]))
                at = upto
            kind = pa.list_(
                pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())])
            )
            keys = ("license", "start", "end", "containment")
            values = pa.array([[dict(zip(keys, one)) for one in rows] for rows in found], kind)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), values], ["doc_id", "found"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(scanned, _FOUND)
