"""License scans: winnowed template fingerprints, then banded alignment.

Templates are word sequences. Their 3-gram hashes are winnowed (the least hash
of every window of ``WINDOW``, as in document fingerprinting), which puts at
least one fingerprint into every run of ``N + WINDOW - 1`` = 4 words. Templates
under ``SHORT`` words keep every 3-gram, those of at most five words every 2-gram.
A text with a copy whose words are at least ``MIN_COVERAGE`` the template's, the
others replaced, holds a run of that length (a fifth of m words replaced leave a
run of 4 from 16 words on, of 3 from 6 on, of 2 below), so no such copy is lost;
one with a word inserted after every third may be. An inverted index of these fingerprints is looked
up for every 3-gram of every text. Hits are parted by diagonal (text minus template position), so copies one
after another are stretches of their own; each is aligned with the template in a
band around its diagonals. Reported are matched coverage and the spans.
"""

import pickle

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import bounded_batches
from tierlake.llm.ngram_index import WORD, Codes, Places, words

N = 3
WINDOW = 2
BAND = 12           # words that the alignment may leave the diagonals of its hits
SHORT = 16          # templates under this many words are not winnowed
MIN_COVERAGE = 0.8  # of the template's words

# Notices of public licenses, by SPDX identifier.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except '
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            'associated documentation files (the "Software"), to deal in the Software without restriction, including '
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License, "
                "or (at your option) any later version"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    # whole notices: where one stands, more words match than with its opening above
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            'associated documentation files (the "Software"), to deal in the Software without restriction, including '
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all "
            'copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY '
            "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
            "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
            "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
            "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
            'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
            "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
            "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
            "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
            "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: 1. Redistributions of source code must retain the "
                     "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions "
                     "in binary form must reproduce the above copyright notice, this list of conditions and the "
                     "following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: 1. Redistributions of source code must retain the "
                     "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions "
                     "in binary form must reproduce the above copyright notice, this list of conditions and the "
                     "following disclaimer in the documentation and/or other materials provided with the distribution. "
                     "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
                     "endorse or promote products derived from this software without specific prior written "
                     "permission."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
                  "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
                  "compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]


def winnow(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the least hash of every window (the last one of equals)."""
    if len(hashes) <= window:
        return np.array([int(len(hashes) - 1 - np.argmin(hashes[::-1]))]) if len(hashes) else np.empty(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(hashes, window)
    return np.unique(window - 1 - view[:, ::-1].argmin(axis=1) + np.arange(len(view)))


def banded_alignment(template: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int, int, int, int]:
    """Best local alignment (match 1, else -1) with text minus template position
    in [low, high]: (score, template start, end, text start, end, matches)."""
    m, n, width = len(template), len(text), high - low + 1
    h = np.zeros((m + 1, width + 2), np.int32)  # column d + 1 holds diagonal low + d; borders stay 0
    slope = np.arange(width)
    diag = low + slope
    for i in range(1, m + 1):
        j = i - 1 + diag
        inside = (j >= 0) & (j < n)
        w = text[np.clip(j, 0, n - 1)]
        pair = np.where(inside & (w == template[i - 1]) & (w >= 0), 1, -1)
        row = np.maximum(np.maximum(h[i - 1, 1:-1] + pair, h[i - 1, 2:] - 1), 0) * inside
        h[i, 1:-1] = (np.maximum.accumulate(row + slope) - slope) * inside
    i, c = (int(x) for x in np.unravel_index(int(h.argmax()), h.shape))
    score, end_i, end_j, hit = int(h[i, c]), i, i + low + c - 1, 0
    j = end_j
    while i > 0 and h[i, c] > 0:
        same = text[j - 1] >= 0 and text[j - 1] == template[i - 1]
        if h[i, c] == h[i - 1, c] + (1 if same else -1):
            hit += int(same)
            i, j = i - 1, j - 1
        elif h[i, c] == h[i - 1, c + 1] - 1:
            i, c = i - 1, c + 1
        else:
            j, c = j - 1, c - 1
    return score, i, end_i, j, end_j, hit


def diagonal_groups(diag: np.ndarray, length: int) -> list[tuple[int, int]]:
    """(lowest, highest) diagonal of the groups of hits, those with more hits first.

    A group ends at a gap of more than half the template (two copies one after
    another are a template apart), ``BAND`` at most, and is never wider than the
    template: the band around it is bounded, however many copies a text holds.
    """
    diag, many = np.unique(diag, return_counts=True)
    gap = min(BAND, max(1, length // 2))
    groups, lo = [], 0
    for i in range(1, len(diag) + 1):
        if i == len(diag) or diag[i] - diag[i - 1] > gap or diag[i] - diag[lo] > length:
            groups.append((-int(many[lo:i].sum()), int(diag[lo]), int(diag[i - 1])))
            lo = i
    return [(a, b) for _, a, b in sorted(groups)]


class Templates:
    def __init__(self, rows):
        kept = [(i, w) for i, w in ((i, words(t)) for i, t in rows) if len(w) >= N]
        self.names = [i for i, _ in kept]
        self.codes = Codes([w for _, w in kept])
        self.words = [self.codes.encode(w) for _, w in kept]
        self.weights = [dict(zip(*(x.tolist() for x in np.unique(w, return_counts=True)))) for w in self.words]
        self.places = {n: self._index(n) for n in (N, N - 1)}

    def _index(self, n: int) -> Places:
        """Fingerprints of the templates searched by n-grams: five words or less by N - 1."""
        keys, passage, position = [], [], []
        for k, w in enumerate(self.words):
            if (n == N) != (len(w) > 5):
                continue
            grams = self.codes.grams(w, n)
            mixed = (grams.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            at = winnow(mixed) if len(w) >= SHORT else np.arange(len(grams))
            keys.append(grams[at])
            passage.append(np.full(len(at), k))
            position.append(at)
        return Places(*(np.concatenate([np.empty(0, np.int64), *x]).astype(np.int64)
                        for x in (keys, passage, position)))

    def scan(self, text: str, min_coverage: float) -> list[tuple]:
        """(license, template, coverage, matched words, first and last+1 character,
        first and last+1 template word), the best of overlapping spans."""
        ws = words(text)
        codes = self.codes.encode(ws)
        at, passage, position = (np.concatenate(x) for x in zip(*(
            places.hits(self.codes.grams(codes, n)) for n, places in self.places.items())))
        found = []
        for p in np.unique(passage).tolist():
            mine = passage == p
            t, free = self.words[p], codes.copy()
            band = min(BAND, len(t))
            for first, last in diagonal_groups(at[mine] - position[mine], len(t)):
                lo, hi = max(0, first - band), min(len(ws), last + band + len(t))
                there = set(free[lo:hi].tolist())
                if sum(n for w, n in self.weights[p].items() if w in there) < min_coverage * len(t):
                    continue  # too few of the template's words
                low, high = first - lo - band, last - lo + band
                while True:  # a group may hold several copies: best first, then beside it
                    _, i, ie, j, je, hit = banded_alignment(t, free[lo:hi], low, high)
                    if not hit or hit < min_coverage * len(t):
                        break
                    found.append((hit, hit / len(t), p, lo + j, lo + je, i, ie))
                    free[lo + j:lo + je] = -1
        found.sort(key=lambda x: (-x[0], -x[1], x[3], x[2]))
        out, taken = [], []
        spans = [x.span() for x in WORD.finditer(text.lower())] if found else []
        for hit, share, p, s, e, i, ie in found:
            if all(e <= a or s >= b for a, b in taken):
                taken.append((s, e))
                out.append((self.names[p], p, share, hit, spans[s][0], spans[e - 1][1], i, ie))
        return out


def scan_licenses(docs: DataFrame, templates=None, key: str = "doc_id", text: str = "text",
                  min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row per license notice found in a text.

    Columns: doc_id, license, template (its number), coverage, matched_words,
    span_start and span_end (characters of the lower-cased text), template_start
    and template_end (words). Of overlapping finds the one with more matched
    words stays, then higher coverage, then the earlier. Whole texts are
    scanned. Null and empty texts and null keys give no row, repeated rows
    repeat their finds, an empty table gives an empty result; other columns are
    not read. ``templates`` (name, text) is a bounded list given by the caller.
    """
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(Templates(TEMPLATES if templates is None else templates)))
    names = ["doc_id", "license", "template", "coverage", "matched_words", "span_start", "span_end",
             "template_start", "template_end"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.float64(), *[pa.int64()] * 5]

    def scan(batches):
        own = pickle.loads(sent.value)
        for batch in batches:
            rows = [(d, *x) for d, t in zip(batch.column("d").to_pylist(), batch.column("t"))
                    for x in own.scan(t.as_py(), min_coverage)]
            cols = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return (docs.select(F.col(key).cast("long").alias("d"), F.col(text).alias("t")).where("d is not null and t is not null")
            .mapInArrow(scan, "doc_id long, license string, template long, coverage double, matched_words long, "
                              "span_start long, span_end long, template_start long, template_end long"))
