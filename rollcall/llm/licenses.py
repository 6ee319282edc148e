"""License scans by conditional compression.

Candidate blocks are the words around cues, across line ends: for templates of each length class as
far as such a template can reach, cut into overlapping windows where cues are dense.  Every block
is compressed alone and with each template as raw zstandard dictionary, and templates are ranked by
how many bytes they save.  A template that saves ``LEAST_SHARE`` of its own compressed size is a
winner; winners are confirmed, in that order, by the exact differences in wording between the
template and the part of the block nearest to it (least edits of words): few of them
(``MOST_DIFFERENT`` of the template's words), and none that touches a word that names a license
(``NAMING``, and every word with a digit).  Confirmed parts are ranked by what the template saves
on them alone, taken, and left out of the block, which is then compressed again until no winner is
left.  Longer classes go first, so that a notice within a longer text is not named a second time.

Defined results: null and empty texts have no license; of parts that overlap the one on which most
bytes are saved is taken, then the one with fewer differences, the longer template, the name that
sorts first; a text names as many licenses as it has, each place by itself; repeated rows are
scanned alike; texts are scanned whole.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rollcall.llm.common import free_name, per_batch, with_fields

# Identifiers of the public list of licenses.
IDENTIFIERS = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause",
    "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0",
    "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "ISC",
    "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT-0",
    "MPL-2.0", "Unlicense", "Zlib")
# Wordings of public license notices.
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met: Redistributions of source code "
    "must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
    "list of conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution.")
TEMPLATES = {
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3."),
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version."),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"),
    "BSD-2-Clause-text": _BSD,
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "BSD-3-Clause-text": _BSD + (
        " Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior "
        "written permission."),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version."),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."),
    "ISC": "Released under the ISC License.",
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies."),
    "LGPL-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version."),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "MIT licensed",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain."),
    "All-Rights-Reserved": "All rights reserved.",
    **{f"SPDX:{name}": f"SPDX-License-Identifier: {name}" for name in IDENTIFIERS},
}
# Words that tell one license from another; a difference that touches one refuses the template.
NAMING = frozenset((
    "affero agpl apache artistic boost bsd bsl by cc clause epl general gnu gpl isc later lesser "
    "lgpl mit mozilla mpl nc nd only public reserved sa unencumbered unlicense "
    "zlib").split())
CUES = re.compile(r"(?ai:licen[cs]|copyright|permission|reserved|redistribution|unencumbered)")
QUICK = ("licen", "copyright", "permission", "reserved", "redistribution", "unencumbered")
LEAST_SHARE = 0.1
MOST_DIFFERENT = 0.2
CLASSES = (16, 72)               # words of the longest template of the shorter classes
_WORD = re.compile(r"[^\W_]+(?:\.[^\W_]+)*")


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def stretches(text: str, reach: int) -> tuple[list[int], list[tuple[int, int]]]:
    """(places of cues, (start, end) of the merged surroundings of cues)."""
    cues, out = [], []
    for m in CUES.finditer(text):
        cues.append(m.start())
        start, end = max(0, m.start() - reach), min(len(text), m.end() + reach)
        if out and start < out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return cues, [(a, b) for a, b in out]


def windows(cues: list[int], reach: int, n: int) -> list[tuple[int, int]]:
    """(first, end) word places around cue words; long ones in parts that overlap by ``reach``."""
    merged: list[list[int]] = []
    for at in cues:
        a, b = max(0, at - reach), min(n, at + reach + 1)
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    out = []
    for a, b in merged:
        while b - a > 4 * reach:
            out.append((a, a + 4 * reach))
            a += 3 * reach
        out.append((a, b))
    return out


def edit_rows(template: np.ndarray, block: np.ndarray, anchored: bool = False) -> list[np.ndarray]:
    """Rows of the table of least word edits: row i, place j is the template's first i words
    against a part of the block that ends before j and starts anywhere, or at 0 if ``anchored``."""
    at = np.arange(len(block) + 1)
    rows = [at.copy() if anchored else np.zeros(len(block) + 1, np.int64)]
    for i, word in enumerate(template, 1):
        new = rows[-1] + 1
        new[1:] = np.minimum(new[1:], rows[-1][:-1] + (block != word))
        new[0] = i
        rows.append(np.minimum.accumulate(new - at) + at)
    return rows


def nearest_parts(template: np.ndarray, block: np.ndarray, most: int):
    """(first, end) of the parts of the block within ``most`` edits, the nearest of each place."""
    last = np.zeros(len(block) + 1, np.int64)
    at = np.arange(len(block) + 1)
    for i, word in enumerate(template, 1):                     # edit_rows, the last row only
        new = last + 1
        new[1:] = np.minimum(new[1:], last[:-1] + (block != word))
        new[0] = i
        last = np.minimum.accumulate(new - at) + at
    ends = np.flatnonzero(last <= most)
    ends = ends[np.argsort(last[ends], kind="stable")]
    free = np.ones(len(last), bool)
    for end in ends.tolist():
        if not free[end]:
            continue
        before = block[max(0, end - len(template) - most):end]
        size = int(np.argmin(edit_rows(template[::-1], before[::-1], anchored=True)[-1]))
        free[max(0, end - size + 1):end + len(template) - most] = False
        if size:
            yield end - size, end


def differences(template: list[str], part: list[str]) -> tuple[int, list[tuple[str, str]]]:
    """(least edits of words, (words left out, words put in) of each place that differs)."""
    codes = {w: k for k, w in enumerate(dict.fromkeys(template + part))}
    a, b = ([codes[w] for w in side] for side in (template, part))
    rows = edit_rows(np.array(a), np.array(b, np.int64), anchored=True)
    i, j, out = len(a), len(b), []
    n, near = int(rows[i][j]), False
    while i or j:
        if i and j and a[i - 1] == b[j - 1] and rows[i][j] == rows[i - 1][j - 1]:
            i, j, near = i - 1, j - 1, False
            continue
        if not near:
            out.append(([], []))
            near = True
        if i and j and rows[i][j] == rows[i - 1][j - 1] + 1:
            i, j = i - 1, j - 1
            out[-1][0].append(template[i])
            out[-1][1].append(part[j])
        elif i and rows[i][j] == rows[i - 1][j] + 1:
            i -= 1
            out[-1][0].append(template[i])
        else:
            j -= 1
            out[-1][1].append(part[j])
    return n, [(" ".join(x[::-1]), " ".join(y[::-1])) for x, y in out[::-1]]


def names_it(word: str) -> bool:
    return word in NAMING or any(c.isdigit() for c in word)


def packer(held: bytes | None = None):
    """Compressor with ``held`` as raw dictionary.

    Literals are stored plain, as zstandard's fast strategy does with a target length: entropy coding
    of the few literals of a block would blur the bytes that matches save.
    """
    import zstandard as zstd

    fixed = zstd.ZstdCompressionParameters.from_level(
        1, strategy=zstd.STRATEGY_FAST, min_match=4, target_length=1, hash_log=13,
        write_content_size=False, write_dict_id=False)
    known = None
    if held is not None:
        known = zstd.ZstdCompressionDict(held, dict_type=zstd.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(compression_params=fixed)
    return zstd.ZstdCompressor(dict_data=known, compression_params=fixed)


class Template:
    def __init__(self, name: str, text: str, alone):
        self.name, self.words = name, words_of(text)
        self.counts = Counter(self.words)
        self.most = int(MOST_DIFFERENT * len(self.words))
        raw = " ".join(self.words).encode()
        self.packer = packer(raw)
        self.least = LEAST_SHARE * len(alone.compress(raw))


class Scanner:
    def __init__(self, templates: dict[str, str]):
        self.alone = packer()
        every = [Template(name, templates[name], self.alone) for name in sorted(templates)]
        every = [t for t in every if t.words]
        self.reach = 2 * max(map(len, templates.values()), default=0)
        self.classes = []
        edges = [0, *CLASSES, 1 << 30]
        for low, high in zip(edges[-2::-1], edges[:0:-1]):     # the longest class first
            held = [t for t in every if low < len(t.words) <= high]
            if held:
                longest = max(len(t.words) + t.most for t in held)
                self.classes.append((longest, held))

    def ranked(self, raw: bytes, held: list[Template]) -> list[tuple[int, Template]]:
        """Winners of a block with the bytes each saves, largest first."""
        size = len(self.alone.compress(raw))
        saved = [(size - len(t.packer.compress(raw)), t) for t in held]
        return sorted(((s, t) for s, t in saved if s >= t.least), key=lambda r: (-r[0], r[1].name))

    def confirmed(self, t: Template, words: list[str], codes: np.ndarray, code: dict[str, int]):
        """(first, end, saved bytes, saving, differences, edits) of the parts that hold ``t``."""
        own = np.array([code.get(w, len(code)) for w in t.words], np.int64)
        for a, b in nearest_parts(own, codes, t.most):
            if (codes[a:b] < 0).any():
                continue
            n, edits = differences(t.words, words[a:b])
            if n > t.most or any(names_it(w) for pair in edits for side in pair
                                 for w in side.split()):
                continue
            raw = " ".join(words[a:b]).encode("utf-8", "replace")
            size = len(self.alone.compress(raw))
            saved = size - len(t.packer.compress(raw))
            yield (a, b, saved, round(saved / size, 6), n,
                   "; ".join(f"-{x}+{y}" for x, y in edits))

    def in_window(self, a: int, b: int, room: int, held: list[Template], vocabulary: list[str],
                  codes: np.ndarray, code: dict[str, int]):
        """(template, first, end, saving, differences, edits) in the window; their words go."""
        lo, hi = max(0, a - room), min(len(codes), b + room)
        while True:
            block = [vocabulary[c] for c in codes[a:b].tolist() if c >= 0]
            winners = self.ranked(" ".join(block).encode("utf-8", "replace"), held)
            if not winners:
                return
            around = codes[lo:hi]
            words = [vocabulary[c] if c >= 0 else "" for c in around.tolist()]
            counts = Counter(words)
            found = []
            for _, t in winners:
                if sum(min(c, counts[w]) for w, c in t.counts.items()) < len(t.words) - t.most:
                    continue                                   # too few of its words are there
                found += [(-saved, n, -len(t.words), t.name, lo + x, lo + y, share, edits)
                          for x, y, saved, share, n, edits in self.confirmed(t, words, around, code)]
            taken = False
            for _, n, _, name, x, y, share, edits in sorted(found):
                if (codes[x:y] >= 0).all():
                    codes[x:y] = -1
                    taken = True
                    yield name, x, y, share, n, edits
            if not taken:
                return

    def __call__(self, text: str | None):
        """[(license, start, end, saving, words that differ, edits)] of a text."""
        if not text:
            return []
        small = text.lower()
        if not any(q in small for q in QUICK):
            return []
        cues, parts = stretches(text, self.reach)
        found = []
        for start, end in parts:
            code: dict[str, int] = {}
            places, starts, ends = array("q"), array("q"), array("q")
            for m in _WORD.finditer(text, start, end):
                places.append(code.setdefault(m.group().lower(), len(code)))
                starts.append(m.start())
                ends.append(m.end())
            if not places:
                continue
            codes, vocabulary = np.array(places, np.int64), list(code)
            here = [max(0, bisect_right(starts, c) - 1)
                    for c in cues[bisect_right(cues, start - 1):bisect_right(cues, end - 1)]]
            for reach, held in self.classes:
                for a, b in windows(here, reach, len(codes)):
                    found += [(name, starts[x], ends[y - 1], share, n, edits)
                              for name, x, y, share, n, edits in self.in_window(
                                  a, b, reach, held, vocabulary, codes, code)]
        return sorted(found, key=lambda f: f[1:3])


FIELDS = ("license string, span_start long, span_end long, saving double, n_different int, "
          "edits string")


def scan(df: DataFrame, text: str = "text", out: str = "licenses",
         templates: dict[str, str] | None = None) -> DataFrame:
    """``df`` with the array ``out`` of the licenses found in each text."""
    slot = free_name(df, out)
    names = [f.split()[0] for f in FIELDS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.string()]
    kind = pa.list_(pa.struct(list(zip(names, kinds))))
    wanted = dict(templates or TEMPLATES)

    def make():
        scanner = Scanner(wanted)

        def run(batch):
            got = [[dict(zip(names, f)) for f in scanner(t)]
                   for t in batch.column(text).to_pylist()]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, kind)],
                                              names=[*batch.schema.names, slot])
        return run

    inner = ", ".join(f"{n}: {t}" for n, t in (f.split() for f in FIELDS.split(", ")))
    return df.mapInArrow(per_batch(make), with_fields(df, f"`{slot}` array<struct<{inner}>>"))
