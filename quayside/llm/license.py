"""License scans: winnowed fingerprints of templates, then banded alignment.

Every template's ``GRAM``-word hashes are winnowed (the least of each ``WINNOW``
neighbours) into an inverted index from fingerprint to (template, place), and a
document is winnowed the same way.  A shared run of ``GRAM + WINNOW - 1`` words
always gives a common fingerprint, but a match need not have one: it covers
``COVERAGE`` of the template's words, so changed and inserted words can part it
into shorter runs.  So the index also holds single words of each template: one
more than a match may leave out, the rarest in the templates, all of them for no
coverage.  Every match has one of those, however many words are inserted.

Hits of one template on nearby diagonals make a candidate; a local alignment in
a band around them counts matched words, unless too few of the template's words
stand there at all.  A match covers at least ``COVERAGE`` of the template's words;
of overlapping matches in a document the one with most matched words stays.

The templates are a small stated table: their index is broadcast after a check
of its size (``MAX_TEMPLATE_BYTES``).  Documents are read whole, in one pass
without a shuffle.

Words: A-Z lower-cased, then runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.

Defined cases: null or wordless texts have no match; a null template or one
without words matches nothing; equal templates are reported by the lesser name; repeated
documents get equal rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common as C

GRAM, WINNOW = 3, 2
BAND = 8
COVERAGE = 0.8
MAX_TEMPLATE_BYTES = 8 << 20

#: Notices of public licenses, by a short name.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("bsd-2-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("mit", "Released under the MIT License."),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]

#: Bytes of words after lower-casing: digits, a-z, and all above ASCII.
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def fingerprints(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word place, hash) of the winnowed fingerprints of documents whose words
    begin at ``first`` (n+1 places)."""
    words = np.diff(first)
    ranged = C.RangeHash(codes)
    short = np.flatnonzero((words > 0) & (words < GRAM))
    at, hashed = first[short], ranged.of(first[short], first[short + 1])
    if len(codes) >= GRAM:
        place = np.arange(len(codes) - GRAM + 1)
        grams = ranged.of(place, place + GRAM)
        doc = np.repeat(np.arange(len(words)), words)[: len(place)]
        whole = place + GRAM <= first[doc + 1]
        # a gram across two documents never wins, and never matches
        order = np.where(whole, grams, np.uint64(0xFFFFFFFFFFFFFFFF))
        chosen = np.unique(C.minimizer_of_window(order, WINNOW)) if len(order) >= WINNOW else place
        lonely = first[:-1][words == GRAM]
        chosen = np.union1d(chosen[whole[chosen]], lonely)
        at, hashed = np.concatenate([at, chosen]), np.concatenate([hashed, grams[chosen]])
    return at, hashed


def needed(words: int, coverage: float) -> int:
    """The least number of matched words that covers a template."""
    return int(np.ceil(coverage * words))


def all_fingerprints(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word place, hash) of the winnowed fingerprints and of every word."""
    at, hashed = fingerprints(codes, first)
    place = np.arange(len(codes))
    return np.concatenate([at, place]), np.concatenate([hashed, C.RangeHash(codes).of(place, place + 1)])


class TemplateIndex:
    def __init__(self, templates: list[tuple[str, str]], coverage: float = COVERAGE) -> None:
        self.names = [n for n, _ in templates]
        raw = [t.encode() for _, t in templates]
        buf = C.LOWER[np.frombuffer(b"".join(raw), np.uint8)] if raw else np.zeros(0, np.uint8)
        off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        starts, ends, first = C.word_spans(buf, off, _WORD)
        codes = C.word_hashes(buf, starts, ends) if len(starts) else np.zeros(0, np.uint64)
        self.words = [codes[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
        at, hashed = fingerprints(codes, first) if len(codes) else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        # single words: one more than may be left out, the rarest in the templates, the longest of equally rare ones
        seen, own = np.unique(codes, return_inverse=True)
        often = np.bincount(own, minlength=len(seen))[own]
        some = [np.zeros(0, np.int64)]
        for a, b in zip(first[:-1], first[1:], strict=True):
            rare = a + np.lexsort((np.arange(b - a), (starts - ends)[a:b], often[a:b]))
            some.append(rare[: b - a - needed(b - a, coverage) + 1])
        single = np.concatenate(some).astype(np.int64)
        if len(single):
            at, hashed = np.concatenate([at, single]), np.concatenate([hashed, C.RangeHash(codes).of(single, single + 1)])
        template = np.searchsorted(first, at, "right") - 1
        order = np.argsort(hashed, kind="stable")
        self.hashed, self.template, self.at = hashed[order], template[order], (at - first[template])[order]

    def hits(self, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which fingerprint, template, place in it) of every common one."""
        lo, hi = np.searchsorted(self.hashed, hashed, "left"), np.searchsorted(self.hashed, hashed, "right")
        entry = C.ranges(lo, hi - lo)
        return np.repeat(np.arange(len(hashed)), hi - lo), self.template[entry], self.at[entry]


def banded_alignment(doc: list[int], template: list[int], diagonal: int, band: int) -> tuple[int, int, int]:
    """(matched words, start, end) in ``doc`` of the best local alignment whose
    cells lie within ``band`` of ``diagonal`` (doc place less template place).
    Match 2, mismatch -1, gap -1."""
    best = (0, 0, 0, 0)  # score, matched, start, end
    above: dict[int, tuple[int, int, int]] = {}
    for t, word in enumerate(template):
        row: dict[int, tuple[int, int, int]] = {}
        for d in range(max(0, t + diagonal - band), min(len(doc), t + diagonal + band + 1)):
            score, matched, start = above.get(d - 1, (0, 0, d))
            if doc[d] == word:
                cell = (score + 2, matched + 1, start)
            else:
                cell = (score - 1, matched, start)
            for score, matched, start in (above.get(d, (0, 0, d)), row.get(d - 1, (0, 0, d))):
                if score - 1 > cell[0]:
                    cell = (score - 1, matched, start)
            if cell[0] > 0:
                row[d] = cell
                if cell[0] > best[0]:
                    best = (cell[0], cell[1], cell[2], d + 1)
        above = row
    return best[1], best[2], best[3]


def matches_of(codes: np.ndarray, index: TemplateIndex, at: np.ndarray, template: np.ndarray, place: np.ndarray, band: int, coverage: float) -> list[tuple[float, int, int, int]]:
    """(coverage, template, first word, last word + 1) of one document, whose
    hits are sorted by template and place."""
    found: list[tuple[int, float, int, int, int]] = []
    for t in np.unique(template):
        own = template == t
        words = index.words[t]
        # an occurrence is a diagonal; hits within the band of the first belong to it, and each has its whole band aligned
        slack = max(1, min(max(band, len(words) // 10), len(words) // 4))
        need = needed(len(words), coverage)
        diagonals = np.unique((at - place)[own])
        i = 0
        while i < len(diagonals):
            lead = int(diagonals[i])
            i = int(np.searchsorted(diagonals, lead + slack, "right"))
            reach = slack + (int(diagonals[i - 1]) - lead + 1) // 2
            centre = lead - slack + reach
            lo, hi = max(0, centre - reach), min(len(codes), centre + reach + len(words))
            there = codes[lo:hi].tolist()
            standing = set(there)
            if sum(w in standing for w in words) < need:
                continue
            matched, start, end = banded_alignment(there, words, centre - lo, reach)
            if matched >= coverage * len(words):
                found.append((matched, matched / len(words), int(t), lo + start, lo + end))
    found.sort(key=lambda f: (-f[0], -f[1], f[3], index.names[f[2]]))
    kept: list[tuple[float, int, int, int]] = []
    for _, share, t, a, b in found:
        if all(b <= x or a >= y for _, _, x, y in kept):
            kept.append((share, t, a, b))
    return sorted(kept, key=lambda k: k[2])


def license_matches(docs: DataFrame, templates: list[tuple[str, str | None]] | None = None, text: str = "text", doc_id: str = "doc_id", band: int = BAND, coverage: float = COVERAGE) -> DataFrame:
    """One row a match: doc_id, license, coverage, start_word, end_word and the
    matched passage's start_byte and end_byte in the UTF-8 text."""
    own = sorted((n, t) for n, t in (TEMPLATES if templates is None else templates) if t)
    if sum(len(t) for _, t in own) > MAX_TEMPLATE_BYTES:
        raise ValueError(f"templates over {MAX_TEMPLATE_BYTES} bytes")
    shared = docs.sparkSession.sparkContext.broadcast(TemplateIndex(own, coverage))
    frame = docs.select(C.exactly(docs, doc_id).alias("doc_id"), C.exactly(docs, text).alias("text"))
    kind = frame.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "license", "coverage", "start_word", "end_word", "start_byte", "end_byte"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            buf, off = C.text_buffer(batch.column(1))
            for lo, hi in C.doc_chunks(off):
                base = off[lo]
                part = C.LOWER[buf[base : off[hi]]]
                starts, ends, first = C.word_spans(part, off[lo : hi + 1] - base, _WORD)
                if not len(starts):
                    continue
                codes = C.word_hashes(part, starts, ends)
                at, hashed = all_fingerprints(codes, first)
                which, template, place = index.hits(hashed)
                spot = at[which]
                doc = np.searchsorted(first, spot, "right") - 1
                rows: list[tuple[int, str, float, int, int, int, int]] = []
                order = np.argsort(doc, kind="stable")
                for group in np.split(order, np.flatnonzero(np.diff(doc[order])) + 1) if len(order) else []:
                    d = int(doc[group[0]])
                    a, b = int(first[d]), int(first[d + 1])
                    for share, t, s, e in matches_of(codes[a:b], index, spot[group] - a, template[group], place[group], band, coverage):
                        begin = int(off[lo + d] - base)
                        rows.append((lo + d, index.names[t], share, s, e, int(starts[a + s]) - begin, int(ends[a + e - 1]) - begin))
                cols = list(zip(*rows, strict=True)) or [[]] * 7
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.float64()), *[pa.array(c, pa.int64()) for c in cols[3:]]], names=names)

    return frame.mapInArrow(C.tidy(run), f"doc_id {kind}, license string, coverage double, start_word long, end_word long, start_byte long, end_byte long")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(C.table(spark, sf_dir, "documents"))
