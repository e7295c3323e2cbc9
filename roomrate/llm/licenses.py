"""License scan (operator 4).

Templates are cut into shingles of five words (ASCII letters lower-cased).
Each length n of a template, in shingles, asks for windows of n shingles,
about eight to a template length (each one, for short templates), so that a
copy of the template shares at least 15 parts in 17 of its shingles with some
window. Windows are retrieved by MinHash bands: ``BANDS`` bands of ``ROWS``
coordinates find a window of that similarity with probability above 1 - 1e-9,
and one of similarity 0.6 with probability above 0.999. A retrieved window is
widened by its step on both sides and verified: the share of the template's
distinct shingles that it contains exactly must be ``CONTAINMENT`` or more.

Windows that hold no shingle of any template cannot share a coordinate with one
and get no signature, so most text costs one look-up a shingle. The templates
are given by the caller and broadcast; their size does not depend on
the documents. Documents are read once, whole, and not shuffled.

Defined results: null and empty texts have no matches; a template with fewer
than five words is one shingle, matched where its words stand; overlapping
matches of one template are one match, from the first to the last word.
Rows keep their multiplicity; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roomrate.llm.common import ALNUM, Words, lower_ascii, mix64, shingle_hashes, string_slices

SHINGLE = 5
CONTAINMENT = 0.8
ROWS, BANDS = 2, 16
STEPS = 8

# Public notices, as their licences word them.
TEMPLATES = {
    "MIT-line": "Released under the MIT License.",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions:"),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
        "in compliance with the License. You may obtain a copy of the License at"),
    "GPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation"),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met:"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
        "the MPL was not distributed with this file, You can obtain one at"),
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _coordinate(place: np.ndarray, i: int) -> np.ndarray:
    """The i-th pseudo-random order of shingles, as 32-bit ranks."""
    x = place + np.uint32((i * 0x9E3779B1 + 0x7F4A7C15) & 0xFFFFFFFF)
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def _places(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(32)).astype(np.uint32)


def _mix_band(key: np.ndarray, value: np.ndarray) -> np.ndarray:
    return key * _ODD + value.astype(np.uint64)


class Library:
    """Compiled templates: distinct shingles, and band tables per length."""

    def __init__(self, templates: dict[str, str], rows: int = ROWS, bands: int = BANDS):
        self.names, self.sets, self.n_words = [], [], []
        self.rows, self.bands = rows, bands
        by_length: dict[int, list[int]] = {}
        for name, text in templates.items():
            low = lower_ascii(np.frombuffer(text.encode(), np.uint8))
            words = Words(low, np.array([0, len(low)]), ALNUM)
            if not len(words):
                continue
            h, _ = shingle_hashes(words, min(SHINGLE, len(words)))
            self.names.append(name)
            self.sets.append(np.unique(h))
            self.n_words.append(len(words))
            by_length.setdefault((len(h), min(SHINGLE, len(words))), []).append(len(self.names) - 1)
        #: sorted shingles of any template
        self.known = np.unique(np.concatenate(self.sets)) if self.sets else np.zeros(1, np.uint64)
        #: (window, step, words in a shingle, per band: sorted keys and their templates)
        self.lengths = []
        for (n, k), members in sorted(by_length.items()):
            tables = [[] for _ in range(bands)]
            for t in members:
                p = _places(self.sets[t])
                for b in range(bands):
                    key = np.full(1, b + 1, np.uint64)
                    for r in range(rows):
                        key = _mix_band(key, _coordinate(p, b * rows + r).min(keepdims=True))
                    tables[b].append((int(mix64(key)[0]), t))
            packed = [(np.array([x for x, _ in sorted(tb)], np.uint64), np.array([t for _, t in sorted(tb)]))
                      for tb in tables]
            self.lengths.append((n, max(1, n // STEPS), k, packed))


def _window_starts(bounds: np.ndarray, n: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """First shingle of every window, and how many shingles it holds: each
    ``step``, the last window ending with the document; a document of fewer
    than ``n`` shingles is one window."""
    size = np.diff(bounds)
    count = np.where(size > n, -(-(size - n) // step) + 1, (size > 0).astype(np.int64))
    begin = np.repeat(bounds[:-1], count)
    i = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    size = np.repeat(size, count)
    start = np.minimum(i * step, np.maximum(size - n, 0))
    return begin + start, np.minimum(size, n)


def retrieve(h: np.ndarray, bounds: np.ndarray, lib: Library, k: int) -> list[tuple[int, int, int]]:
    """(template, first shingle, shingles) of windows that share a band.

    A coordinate of a window equals one of a template only if the shingle that
    gives it is in both, so windows without any template's shingle share no
    band and get no signature."""
    asked = [x for x in lib.lengths if x[2] == k]
    if not len(h) or not asked:
        return []
    known = lib.known[np.minimum(np.searchsorted(lib.known, h), len(lib.known) - 1)] == h
    if not known.any():
        return []
    before = np.concatenate([[0], np.cumsum(known)])
    place, out = _places(h), []
    for n, step, _, tables in asked:
        start, size = _window_starts(bounds, n, step)
        some = before[start + size] > before[start]
        start, size = start[some], size[some]
        if not len(start):
            continue
        # shingles of each window (a short one repeats its last)
        window = place[start[:, None] + np.minimum(np.arange(n)[None, :], size[:, None] - 1)]
        hits = set()
        # a single shingle is its own minimum: one band finds it surely
        for b in range(lib.bands if n > 1 else 1):
            key = np.full(len(start), b + 1, np.uint64)
            for r in range(lib.rows):
                key = _mix_band(key, _coordinate(window, b * lib.rows + r).min(axis=1))
            key = mix64(key)
            table, members = tables[b]
            lo, hi = np.searchsorted(table, key, "left"), np.searchsorted(table, key, "right")
            for w in np.flatnonzero(hi > lo).tolist():
                hits.update((int(t), w) for t in members[lo[w]:hi[w]])
        out += [(t, int(start[w]), int(size[w])) for t, w in hits]
    return out


def scan_slice(raw: np.ndarray, offsets: np.ndarray, lib: Library, containment: float) -> list[list[tuple]]:
    """Per text: (template, containment, first word, end word) of matches."""
    words = Words(lower_ascii(raw), offsets, ALNUM)
    out: list[list[tuple]] = [[] for _ in range(len(offsets) - 1)]
    for k in sorted({x[2] for x in lib.lengths}):
        h, bounds = shingle_hashes(words, k)
        spans: dict[tuple[int, int], list[tuple[int, int, float]]] = {}
        for t, start, size in retrieve(h, bounds, lib, k):
            d = int(np.searchsorted(bounds, start, "right")) - 1
            step = max(1, size // STEPS)
            a, z = max(start - step, int(bounds[d])), min(start + size + step, int(bounds[d + 1]))
            inside = np.isin(h[a:z], lib.sets[t])
            share = len(np.unique(h[a:z][inside])) / len(lib.sets[t])
            if share >= containment - 1e-12:
                at = np.flatnonzero(inside)
                spans.setdefault((d, t), []).append((a + int(at[0]), a + int(at[-1]) + 1, share))
        for (d, t), found in spans.items():
            merged: list[list] = []
            for a, z, share in sorted(found):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], z)
                    merged[-1][2] = max(merged[-1][2], share)
                else:
                    merged.append([a, z, share])
            n_words = int(words.bounds[d + 1] - words.bounds[d])
            for a, z, share in merged:
                first = a - int(bounds[d])
                out[d].append((lib.names[t], share, first, min(z - int(bounds[d]) - 1 + k, n_words)))
    return [sorted(x, key=lambda m: (m[2], m[3], m[0])) for x in out]


_MATCH = pa.list_(pa.struct([("template", pa.string()), ("containment", pa.float64()),
                             ("first_word", pa.int32()), ("end_word", pa.int32())]))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, matches array<struct<template, containment, first_word, end_word>>)
    of every row, in the order of the text (word numbers from 0, end
    exclusive)."""
    box = docs.sparkSession.sparkContext.broadcast(Library(TEMPLATES if templates is None else templates))

    def run(batches):
        for b in batches:
            for ids, raw, offsets in string_slices(b.column(0), b.column(1)):
                found = scan_slice(raw, offsets, box.value, containment)
                rows = [[dict(zip(("template", "containment", "first_word", "end_word"), m)) for m in x]
                        for x in found]
                yield pa.RecordBatch.from_arrays([ids, pa.array(rows, _MATCH)], [id_col, "matches"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, matches array<struct<template:string,containment:double,first_word:int,end_word:int>>")
