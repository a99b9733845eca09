"""License scans: MinHash bands over overlapping windows, then exact shingle containment."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from punctua.llm.common import frames_of, mix, ragged, words_of

# Wording of common licence notices.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
    "later version.",
    "mit-line": "Released under the MIT License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions:",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:",
}
# Notices and clauses of further licences, by licence or licence-part.
NOTICES = {
    "apache-2.0-terms": "Unless required by applicable law or agreed to in writing, software distributed under the License is "
    "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
    "for the specific language governing permissions and limitations under the License.",
    "gpl-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
    "later version.",
    "gpl-2.0-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License version 2 as published by the Free Software Foundation.",
    "lgpl-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
    "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
    "option) any later version.",
    "lgpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
    "any later version.",
    "agpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
    "any later version.",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the Software.",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-3-clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.",
    "bsd-warranty": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE "
    "ARE DISCLAIMED.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "epl-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
    "which is available at https://www.eclipse.org/legal/epl-2.0/",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
    "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
    "commercial or non-commercial, and by any means.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}
# How short forms begin, and the names that follow them, by licence.
VERBS = ("licensed", "released", "distributed", "available", "provided", "published")
NAMES = {
    "apache-2.0": ("the Apache License 2.0", "the Apache License, Version 2.0"),
    "mit": ("the MIT License", "the terms of the MIT License"),
    "bsd-2-clause": ("the BSD 2-Clause License", "the 2-Clause BSD License"),
    "bsd-3-clause": ("the BSD 3-Clause License", "the 3-Clause BSD License"),
    "isc": ("the ISC License",),
    "mpl-2.0": ("the Mozilla Public License 2.0", "the Mozilla Public License, Version 2.0"),
    "epl-2.0": ("the Eclipse Public License 2.0",),
    "gpl-2.0": ("the GNU General Public License v2.0", "the GNU General Public License, version 2"),
    "gpl-3.0": ("the GNU General Public License v3.0", "the GNU General Public License, version 3"),
    "lgpl-2.1": ("the GNU Lesser General Public License v2.1", "the GNU Lesser General Public License, version 2.1"),
    "lgpl-3.0": ("the GNU Lesser General Public License v3.0", "the GNU Lesser General Public License, version 3"),
    "agpl-3.0": ("the GNU Affero General Public License v3.0", "the GNU Affero General Public License, version 3"),
    "cc-by-4.0": ("CC BY 4.0", "a Creative Commons Attribution 4.0 International License"),
    "cc-by-sa-4.0": ("CC BY-SA 4.0", "Creative Commons BY-SA 4.0",
                     "a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "cc-by-nc-4.0": ("CC BY-NC 4.0", "Creative Commons BY-NC 4.0",
                     "a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "cc-by-nd-4.0": ("CC BY-ND 4.0", "Creative Commons BY-ND 4.0",
                     "a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "cc-by-nc-sa-4.0": ("CC BY-NC-SA 4.0", "Creative Commons BY-NC-SA 4.0",
                        "a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
}


def usual_templates() -> dict[str, str]:
    """Notices, clauses and short forms of the usual licences, by ``licence-part``."""
    given = {t.rstrip(".").lower() for t in TEMPLATES.values()}
    lines = {f"{licence}-line-{k}-{verb}": f"{verb} under {name}"
             for licence, names in NAMES.items() for k, name in enumerate(names) for verb in VERBS
             if f"{verb} under {name}".lower() not in given}
    return TEMPLATES | NOTICES | lines


FOUND = "doc_id bigint, licence string, containment double, start bigint, words bigint"


def _plain() -> np.ndarray:
    table = np.full(256, ord(" "), np.uint8)
    for c in "abcdefghijklmnopqrstuvwxyz0123456789":
        table[ord(c)] = table[ord(c.upper())] = ord(c)
    return table


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, offsets by text): runs of a-z and 0-9, A-Z lower-cased, all else a gap."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data else np.zeros(0, np.uint8)
    plain = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer((at - at[0]).tobytes()), pa.py_buffer(_plain()[raw].tobytes()))
    codes, out, distinct = words_of(plain)
    known = np.fromiter((xxhash.xxh64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))
    return known[codes], out


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words, in order; all of a shorter text as one."""
    n = max(len(words) - width + 1, min(1, len(words)))
    h = np.zeros(n, np.uint64)
    for j in range(min(width, len(words))):
        h = mix(h ^ words[j:j + n], j)
    return h


def bands_for(similarity: float, rows: int, certain: float) -> int:
    """Bands of ``rows`` coordinates that collide at ``similarity`` with probability ``certain``."""
    return math.ceil(math.log(1 - certain) / math.log(1 - similarity**rows))


class Scanner:
    """Templates by length class, with their bands.

    Class L holds templates of over L / 2 to L words; its windows have 2 L words and start
    every L, so that any L words in a row lie whole in one of them.  A window that contains
    the share ``least`` of a template's shingles is thereby at least ``similarity`` alike,
    and the band count makes them meet with probability ``certain``.
    """

    def __init__(self, templates: dict[str, str], width: int, least: float, rows: int, certain: float, whole: frozenset = frozenset()):
        self.width, self.least, self.rows, self.classes = width, least, rows, {}
        self.whole = whole
        for name, text in sorted(templates.items()):
            words, _ = hashed_words(pa.array([text]))
            if not len(words):
                continue
            size = 1 << max(3, (len(words) - 1).bit_length())
            marks = np.unique(shingles(words, width))
            self.classes.setdefault(size, []).append((name, marks, len(words)))
        self.all = np.unique(np.concatenate([m for c in self.classes.values() for _, m, _ in c] or [np.zeros(0, np.uint64)]))
        self.marks = {size: np.unique(np.concatenate([m for _, m, _ in held])) for size, held in self.classes.items()}
        self.bands, self.tables = {}, {}
        for size, held in self.classes.items():
            # share * |template| shared of at most |window| + (1 - share) * |template| in all
            alike = min(least * len(m) / (2 * size + (1 - least) * len(m)) for _, m, _ in held)
            self.bands[size] = bands_for(alike, rows, certain)
            table = {}
            for k, (_, marks, _) in enumerate(held):
                for key in self._keys(marks, self.bands[size]):
                    table.setdefault(key, set()).add(k)
            self.tables[size] = table

    def _keys(self, marks: np.ndarray, bands: int) -> list[tuple[int, int]]:
        seeds = mix(np.arange(bands * self.rows), 5)
        least = mix(marks[None, :] ^ seeds[:, None]).min(1).reshape(bands, self.rows)
        value = np.zeros(bands, np.uint64)
        for r in range(self.rows):
            value = mix(value ^ least[:, r], r)
        return list(enumerate(value.tolist()))

    def scan(self, words: np.ndarray, h: np.ndarray, hits: np.ndarray) -> dict[str, tuple[float, int, int]]:
        """{licence: (best containment, its window's first word, words in it)} of one text.

        ``hits`` are the shingles that occur in some template: windows without any
        contain nothing of a template and are not hashed; a class asks for its own ones.
        """
        found = {}
        for size, held in self.classes.items():
            own = hits[np.isin(h[hits], self.marks[size])]
            first = np.unique(np.concatenate([own // size, np.maximum(own // size - 1, 0)]))
            for w in first.tolist():
                part = h[w * size:w * size + max(1, 2 * size - self.width + 1)]
                if not len(part):
                    continue
                marks = np.unique(part)
                met = set().union(*(self.tables[size].get(key, ()) for key in self._keys(marks, self.bands[size])))
                for k in met:
                    name, want, _ = held[k]
                    share = np.isin(want, marks, assume_unique=True).mean()
                    if share >= (1 if name in self.whole else self.least) and (name not in found or share > found[name][0]):
                        found[name] = (float(share), w * size, min(2 * size, len(words) - w * size))
        return found


def unrivalled(found: dict[str, tuple[float, int, int]], families: dict[str, str]) -> dict[str, tuple[float, int, int]]:
    """``found`` without templates that a better one of their family outdoes in an overlapping window."""
    out = {}
    for name, (share, start, n) in found.items():
        family = families.get(name)
        if family is None or not any(
            families.get(other) == family and s > share and a < start + n and start < a + m
            for other, (s, a, m) in found.items()
        ):
            out[name] = (share, start, n)
    return out


def licences(
    docs: DataFrame, templates: dict[str, str] = TEMPLATES, width: int = 5, least: float = 0.8, rows: int = 1,
    certain: float = 0.99999, id_col: str = "doc_id", text: str = "text", families: dict[str, str] | None = None,
    whole: frozenset = frozenset(),
) -> DataFrame:
    """``(doc_id, licence, containment, start, words)``: one row for each licence in each document.

    A licence is in a document if some window of it contains the share ``least`` of the
    template's ``width``-word shingles; the best (then first) window is given.  Templates
    in ``whole`` must be contained entirely.  Of templates that ``families`` gives one
    family, as versions of one notice, one is left out where its window overlaps that of
    another with a greater share.  One pass without a shuffle; templates are a parameter
    and travel with the task.

    Defined cases: null, empty and wordless texts give no row, nor does an empty table or
    an empty template; texts of under ``width`` words are one shingle; rows may repeat, null ids stay null.
    """
    def run(batches):
        scanner = Scanner(templates, width, least, rows, certain, whole)
        for b in frames_of(batches, 16 << 20):
            words, at = hashed_words(b.column(1))
            sizes = np.diff(at)
            n = np.maximum(sizes - width + 1, np.minimum(sizes, 1))
            place = ragged(at[:-1], n)
            span = np.repeat(np.minimum(width, sizes), n)
            h = np.zeros(len(place), np.uint64)
            for j in range(width):
                ok = span > j
                h[ok] = mix(h[ok] ^ words[place[ok] + j], j)
            start = np.r_[0, np.cumsum(n)]
            hits = np.flatnonzero(np.isin(h, scanner.all))
            owner = np.searchsorted(start, hits, "right") - 1
            out, names = [], b.column(0)
            for i in np.unique(owner).tolist():
                own = hits[np.searchsorted(owner, i):np.searchsorted(owner, i, "right")] - start[i]
                held = unrivalled(scanner.scan(words[at[i]:at[i + 1]], h[start[i]:start[i + 1]], own), families or {})
                for name, (share, first, size) in sorted(held.items()):
                    out.append((names[i].as_py(), name, share, first, size))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()))],
                                                 names=[c.split()[0] for c in FOUND.split(", ")])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(run, FOUND)
