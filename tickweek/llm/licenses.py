"""License scan: MinHash bands over overlapping text windows, then exact containment.

A text's word shingles are cut into blocks of ``s`` shingles for a few sizes
``s``; two neighbouring blocks are a window, so windows overlap by half and any
run of up to ``s + 1`` shingles lies in one. A template is looked for with the
smallest ``s`` that is not below its own number of shingles less one. A window that holds
``CONTAINED`` of the template then shares at least ``CONTAINED / 4`` of their
union (less a little for tiny templates), and with ``BANDS`` bands of one value
it misses the template with a probability under 2e-6. What bands retrieve is
verified on the shingles themselves; a match must hold a version number if the
template has one. Texts without any shingle of a template skip the bands. Of
templates that match at the same place only the best contained is reported, of
equals the longest. Words are compared without punctuation at their edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweek.llm.common import documents, slices
from tickweek.llm.neardup import HASH_A, HASH_B, SHINGLE, shingle_rows

BANDS = 64
CONTAINED = 0.75

_EDGE = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_QUOTES = str.maketrans("“”„«»‘’", "\"\"\"\"\"''")


def _gnu(kind: str, version: str, thing: str = "program") -> str:
    verb, thing = ("This program is", "program") if thing == "program" else (f"This {thing} is", thing)
    return (
        f"{verb} free software: you can redistribute it and/or modify it under the terms of the GNU {kind} License as published "
        f"by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
    )


_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met:"
)
_BSD_2 = (
    f"{_BSD} 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_CC = {
    "CC-BY": "Attribution",
    "CC-BY-SA": "Attribution-ShareAlike",
    "CC-BY-ND": "Attribution-NoDerivatives",
    "CC-BY-NC": "Attribution-NonCommercial",
    "CC-BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "CC-BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}

# License notices as public licences word them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0-or-later": _gnu("Affero General Public", "3"),
    "AGPL-3.0-text": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "Apache-2.0-text": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "BSD": _BSD,
    "BSD-2-Clause": _BSD_2,
    "BSD-3-Clause": (
        f"{_BSD_2} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."
    ),
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, '
        "execute, and transmit the Software, and to prepare derivative works of the Software"
    ),
    "BSL-1.0-header": "Distributed under the Boost Software License, Version 1.0.",
    "CC0-1.0": "This work is licensed under CC0 1.0 Universal.",
    "CC0-1.0-waiver": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-or-later": _gnu("General Public", "2"),
    "GPL-2.0-text": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc.",
    "GPL-3.0-text": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-2.1-or-later": _gnu("Lesser General Public", "2.1", "library"),
    "LGPL-2.1-text": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0-or-later": _gnu("Lesser General Public", "3"),
    "LGPL-3.0-text": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "MPL-1.1": (
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use "
        "this file except in compliance with the License."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MPL-2.0-text": "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software."
    ),
    **{f"{k}-{v}": f"Licensed under {k[:2]} {k[3:]} {v}." for k in _CC for v in ("3.0", "4.0") if (k, v) != ("CC-BY-NC", "4.0")},
    **{f"{k}-4.0-notice": f"This work is licensed under a Creative Commons {n} 4.0 International License." for k, n in _CC.items()},
    **{f"{k}-3.0-notice": f"This work is licensed under a Creative Commons {n} 3.0 Unported License." for k, n in _CC.items()},
    "all-rights-reserved": "All rights reserved.",
}


def bare(text: str | None) -> tuple[str, np.ndarray]:
    """The text's words without punctuation at their edges, and the place of each in the text; words of nothing else are left out."""
    text = text or ""
    words = (text if text.isascii() else text.translate(_QUOTES)).encode().split()
    stripped = [w.strip(_EDGE) for w in words]
    return b" ".join(w for w in stripped if w).decode(), np.flatnonzero([len(w) for w in stripped])


class Templates:
    """Shingles of each template, and per window size the band values that lead to it."""

    def __init__(self, texts: dict[str, str]) -> None:
        self.names = sorted(k for k, t in texts.items() if t and t.split())
        rows, shorter = shingle_rows([texts[k] for k in self.names])
        self.sets = [np.unique(r) for r in rows]
        self.all = np.unique(np.concatenate([np.zeros(0, np.uint64), *rows]))
        # the shingles of each template that hold a number
        digits = [[any(48 <= c < 58 for c in w) for w in texts[k].encode().split()] for k in self.names]
        self.numbers = [r[[any(d[i : i + SHINGLE]) for i in range(len(r))]] for r, d in zip(rows, digits, strict=True)]
        # templates of fewer words than a shingle are found as word runs of their own length
        self.words = {k: n for k, n in enumerate(shorter) if n}
        self.sizes: dict[int, list[int]] = {}
        for k, s in enumerate(self.sets):
            if k not in self.words:
                size = 1 << max(0, int(np.ceil(np.log2(max(1, len(s) - 1)))))
                self.sizes.setdefault(size if len(s) > 1 else 0, []).append(k)
        self.bands = {
            size: [(k, ((self.sets[k][:, None] * HASH_A[:BANDS] + HASH_B[:BANDS]) >> np.uint64(32)).min(0)) for k in ks]
            for size, ks in self.sizes.items()
            if size
        }

    def find(self, row: np.ndarray, runs: dict[int, np.ndarray]) -> list[tuple[int, int, float]]:
        """Matches in a text's shingles (in text order): template, first shingle, share contained.

        ``runs`` has the text's word runs of each length that short templates need.
        """
        found = []
        for k, n in self.words.items():
            found += [(k, 1.0, np.array([i])) for i in np.flatnonzero(runs[n] == self.sets[k][0])]
        known = len(row) and self.all[np.minimum(np.searchsorted(self.all, row), len(self.all) - 1)] == row if len(self.all) else 0
        if not np.any(known):
            return self._best(found)
        for k in self.sizes.get(0, ()):  # one shingle: present or not
            found += [(k, 1.0, np.array([i])) for i in np.flatnonzero(row == self.sets[k][0])]
        if not self.bands:
            return self._best(found)
        least = min(self.bands)
        mins = []
        for a in range(0, len(row), least * 512):  # bounded memory for very long texts
            part = row[a : a + least * 512]
            h = (part[:, None] * HASH_A[:BANDS] + HASH_B[:BANDS]) >> np.uint64(32)
            mins.append(np.minimum.reduceat(h, np.arange(0, len(part), least), axis=0))
        blocks, size = np.concatenate(mins), least
        while size <= max(self.bands):
            if size in self.bands:
                windows = np.minimum(blocks, np.concatenate([blocks[1:], blocks[-1:]]))
                for k, values in self.bands[size]:
                    hits = np.flatnonzero((windows == values).any(1))
                    found += self._verified(row, k, hits * size, 2 * size)
            blocks = np.minimum.reduceat(blocks, np.arange(0, len(blocks), 2), axis=0)
            size *= 2
        return self._best(found)

    def _best(self, found: list[tuple[int, float, np.ndarray]]) -> list[tuple[int, int, float]]:
        """Matches of which better ones do not hold half or more of the shingles."""
        taken: set[int] = set()
        best = []
        for k, share, places in sorted(found, key=lambda x: (-x[1], -len(self.sets[x[0]]), int(x[2][0]), x[0])):
            here = places.tolist()
            if 2 * sum(p in taken for p in here) < len(here):
                taken.update(here)
                best.append((k, here[0], share))
        return best

    def _verified(self, row: np.ndarray, k: int, starts: np.ndarray, width: int) -> list[tuple[int, float, np.ndarray]]:
        """Of neighbouring windows that hold enough of the template, the one that holds most."""
        found: list[tuple[int, float, np.ndarray]] = []
        last = -width
        for a in starts.tolist():
            inside = np.isin(row[a : a + width], self.sets[k])
            share = len(np.unique(row[a : a + width][inside])) / len(self.sets[k])
            numbers = self.numbers[k]
            if share >= CONTAINED and (not len(numbers) or np.isin(numbers, row[a : a + width]).any()):
                hit = (k, share, a + np.flatnonzero(inside))
                if found and a - last < width:
                    found[-1] = max(found[-1], hit, key=lambda x: (x[1], -int(x[2][0])))
                else:
                    found.append(hit)
                last = a
        return found


def scan(docs: DataFrame, texts: dict[str, str] | None = None) -> DataFrame:
    """``doc_id`` and ``matches`` (license, word, contained) of every row of ``docs``.

    ``word`` is the first word of the match, counted from 0. Templates of one to
    four words must occur word for word. NULL, empty and short texts have no
    matches; repeated rows are scanned alike; without templates nothing matches.
    Only ``doc_id`` and ``text`` are read.
    """
    templates = Templates({k: bare(t)[0] for k, t in (TEMPLATES if texts is None else texts).items()})
    shared = docs.sparkSession.sparkContext.broadcast(templates)  # the caller's list of notices, not corpus data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        short = sorted(set(t.words.values()))
        kind = pa.list_(pa.struct([("license", pa.string()), ("word", pa.int64()), ("contained", pa.float64())]))
        for batch in slices(batches):
            texts_, places = zip(*map(bare, batch["text"].to_pylist()), strict=True)
            rows, _ = shingle_rows(texts_)
            runs = {n: shingle_rows(texts_, n, exact=True)[0] for n in short}
            matches = []
            for i, row in enumerate(rows):
                hits = sorted((t.names[k], int(places[i][a]), s) for k, a, s in t.find(row, {n: runs[n][i] for n in short}))
                matches.append([{"license": n, "word": a, "contained": s} for n, a, s in hits])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(matches, kind)], ["doc_id", "matches"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, matches array<struct<license:string,word:bigint,contained:double>>"
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_distinct("matches.license"), ",").alias("licenses"),
        F.array_min("matches.word").alias("first_word"),
        F.array_min("matches.contained").alias("least_contained"),
    )
