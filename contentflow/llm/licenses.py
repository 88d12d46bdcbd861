"""License scans by conditional compression.

1. *Candidates.* A notice holds ``covered`` of its template's words in order, so it holds
   one of its rarest words (as many as may be missing, and one more).  Around every such
   word in the whole text a region of twice the template's length to both sides is a
   candidate; regions that touch are one block.  Layout plays no part: lines are not cut.
2. *Compression.* A span of a block that holds enough of a template's words (longest
   common subsequence) is compressed with the template as zstandard raw dictionary; the
   bytes saved over the span's compressed size alone rank the templates.
3. *Exact differences.* Best savings first: of overlapping spans whose savings are within
   ``NEAR`` bytes of the best, the one with the fewest missing and extra words wins.  A span
   is refused if a word that names the license is missing from it, if a word stands in it
   that names another or denies it (lesser, noderivatives, not ...), or if it is denied
   right before.  A notice's words are taken out and the rest of the block is looked at
   again, so a block can hold several licenses; no template is left out by its rank.

Defined cases: null and empty texts have no candidate; last ties go to the name; lines of
any length are read whole; the same license twice in a document gives two rows; rows that
share a doc_id are reported each; ``first_line`` is the line on which the notice begins.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: notices by which works are put under a license, from the public license texts.
TEMPLATES = {
    "AGPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-2.1-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT-line": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}
# FIXED VALUES: words that name a license (a notice without one of its own is another's or
# none), and words that, put into a notice, name another or deny it.
NAMING = frozenset("affero apache attribution cc commons creative general gnu lesser mit mozilla mpl nc noderivatives noncommercial sharealike".split())
CHANGING = frozenset("affero lesser library nc nd sa noncommercial noderivatives noderivs sharealike non not never no neither nor cannot isn wasn aren".split())
DENIAL = frozenset("not never no neither nor cannot isn wasn aren".split())
NEAR = 16  # bytes of saving that do not decide between two templates
WORDS = re.compile(r"[a-z0-9]+(?:[.+][0-9]+)*")


def words(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def rarest(templates: dict[str, list[str]], need: dict[str, int]) -> dict[str, frozenset[str]]:
    """Per template, words of which every notice holds one: together they stand at more
    places of the template than may be missing.  Words of few templates, and long ones,
    are taken first."""
    spread = Counter(w for v in templates.values() for w in set(v))
    out = {}
    for name, v in templates.items():
        count, places, chosen = Counter(v), 0, set()
        for w in sorted(count, key=lambda w: (not w.isalpha(), spread[w], -len(w), w)):
            if places > len(v) - need[name]:
                break
            chosen.add(w)
            places += count[w]
        out[name] = frozenset(chosen)
    return out


class Scanner:
    """Finds the notices of ``templates`` in texts."""

    def __init__(self, templates: dict[str, str], covered: float):
        self.plain = zstandard.ZstdCompressor(level=3)
        self.words = {k: w for k, w in ((k, words(v)) for k, v in templates.items()) if w}
        self.with_dict = {k: zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(
            " ".join(v).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for k, v in self.words.items()}
        self.count = {k: Counter(v) for k, v in self.words.items()}
        self.need = {k: max(1, math.ceil(covered * len(v) - 1e-9)) for k, v in self.words.items()}
        self.rare = rarest(self.words, self.need)
        # The first word in place is one of these.
        self.heads = {k: set(v[:len(v) - self.need[k] + 1]) for k, v in self.words.items()}
        self.bits = {}
        for k, v in self.words.items():
            bits = self.bits[k] = {}
            for i, w in enumerate(v):
                bits[w] = bits.get(w, 0) | 1 << i

    def saving(self, name: str, have: list[str]) -> tuple[int, int]:
        """Bytes that the template saves as dictionary, and the compressed size alone."""
        data = " ".join(have).encode()
        alone = len(self.plain.compress(data))
        return alone - len(self.with_dict[name].compress(data)), alone

    def rows(self, name: str, have: list[str]) -> list[int]:
        """Bit rows of the longest common subsequence with the template: the template's
        first i words and ``have[:j]`` share as many words, in order, as row j has zeros
        among its i low bits."""
        bits, full = self.bits[name], (1 << len(self.words[name])) - 1
        out = [full]
        for w in have:
            v = out[-1]
            u = v & bits[w]
            out.append(((v + u) | (v - u)) & full)
        return out

    def spans(self, name: str, have: list[str], places: dict[str, list[int]]) -> Iterator[tuple[int, int, int]]:
        """``(words in place, start, end)`` of the spans of at most twice the template's
        words that hold enough of its words in order: for each start the shortest one
        with the most.  Spans that lack the words in any order are not compared."""
        count, need, reach = self.count[name], self.need[name], 2 * len(self.words[name])
        if sum(min(n, len(places.get(w, ()))) for w, n in count.items()) < need:
            return
        at = sorted(p for w in count for p in places.get(w, ()))
        held, total, j = Counter(), 0, 0
        for i, p in enumerate(at):
            while j < len(at) and at[j] < p + reach:
                w = have[at[j]]
                held[w] += 1
                total += held[w] <= count[w]
                j += 1
            if total >= need and have[p] in self.heads[name]:
                rows = self.rows(name, [have[q] for q in at[i:j]])
                most = len(self.words[name]) - rows[-1].bit_count()
                if most >= need:
                    last = next(k for k, v in enumerate(rows) if len(self.words[name]) - v.bit_count() == most)
                    yield most, p, at[i + last - 1] + 1
            total -= held[have[p]] <= count[have[p]]
            held[have[p]] -= 1

    def aligned(self, name: str, have: list[str], start: int, end: int) -> list[tuple[int, int]]:
        """``(place in the text, place in the template)`` of the words in place, last first."""
        at = [p for p in range(start, end) if have[p] in self.bits[name]]
        rows = self.rows(name, [have[p] for p in at])

        def shared(j: int, i: int) -> int:
            return i - (rows[j] & ((1 << i) - 1)).bit_count()

        out, i = [], len(self.words[name])
        for j in range(len(at), 0, -1):
            if shared(j, i) > shared(j - 1, i):
                while shared(j, i - 1) == shared(j, i):
                    i -= 1
                i -= 1
                out.append((at[j - 1], i))
        return out

    def matched(self, name: str, have: list[str], start: int, end: int) -> list[int]:
        """Places of the template's words in the span."""
        return [p for p, _ in self.aligned(name, have, start, end)]

    def refused(self, name: str, have: list[str], start: int, end: int) -> bool:
        """Whether the exact differences make the span no notice of this license."""
        want, pairs = self.words[name], self.aligned(name, have, start, end)
        missing = set(range(len(want))) - {i for _, i in pairs}
        if any(want[i] in NAMING or want[i][0].isdigit() for i in missing):
            return True
        own = {p for p, _ in pairs}
        if any(have[p] in CHANGING for p in range(start, end) if p not in own):
            return True
        before = [w for w in have[max(0, start - 2):start] if w not in ("be", "been", "being", "t")]
        return bool(before) and before[-1] in DENIAL

    def candidates(self, have: list[str]) -> list[tuple[int, int]]:
        """Regions around the templates' rarest words, those that touch as one."""
        where: dict[str, list[int]] = {}
        wanted = frozenset().union(*self.rare.values()) if self.rare else frozenset()
        for i, w in enumerate(have):
            if w in wanted:
                where.setdefault(w, []).append(i)
        around = sorted((max(0, p - 2 * len(self.words[name])), min(len(have), p + 2 * len(self.words[name]) + 1))
                        for name, rare in self.rare.items() for w in rare for p in where.get(w, ()))
        out: list[list[int]] = []
        for a, b in around:
            if out and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        return [(a, b) for a, b in out]

    def scan(self, text: str) -> Iterator[tuple[int, str, float, int, int, int]]:
        """``(first line, license, reduction, words, missing, extra)``."""
        low = text.lower()
        have, starts = [], []
        for m in WORDS.finditer(low):
            have.append(m[0])
            starts.append(m.start())
        for a, b in self.candidates(have):
            for place, *found in self.block(have[a:b]):
                yield (low.count("\n", 0, starts[a + place]), *found)

    def block(self, have: list[str]) -> Iterator[tuple[int, str, float, int, int, int]]:
        """``(first word, license, reduction, words, missing, extra)`` of the notices."""
        at = list(range(len(have)))
        while True:
            places: dict[str, list[int]] = {}
            for i, w in enumerate(have):
                places.setdefault(w, []).append(i)
            hits = []
            for name, want in self.words.items():
                for same, a, b in self.spans(name, have, places):
                    saved, alone = self.saving(name, have[a:b])
                    hits.append((-saved, len(want) - same + b - a - same, name, a, b, same, saved / alone))
            hits.sort()
            gone, used, told = set(), bytearray(len(have)), []
            for k, hit in enumerate(hits):
                if any(used[hit[3]:hit[4]]):  # looked at again without the words that are gone
                    continue
                # Savings this close do not decide: the exact differences do.
                near = [h for h in hits[k:] if h[0] - hit[0] <= NEAR and h[3] < hit[4] and hit[3] < h[4] and not any(used[h[3]:h[4]])]
                near = [h for h in sorted(near, key=lambda h: (h[1], h[0], h[2], h[3])) if not self.refused(h[2], have, h[3], h[4])]
                if not near:
                    continue
                _, _, name, a, b, same, reduction = near[0]
                used[a:b] = b"\1" * (b - a)
                told.append((at[a], name, reduction, len(self.words[name]), len(self.words[name]) - same, b - a - same))
                gone.update(self.matched(name, have, a, b))
            yield from told
            if not gone:
                return
            keep = [i for i in range(len(have)) if i not in gone]
            have, at = [have[i] for i in keep], [at[i] for i in keep]


def license_findings(docs: DataFrame, templates: dict[str, str] | None = None, covered: float = 0.9) -> DataFrame:
    """``doc_id, first_line, license, reduction, n_words, missing, extra``: a row per
    notice found.  ``covered``: share of the template's words that must be there, in
    order; every template is compared, whatever its rank."""
    templates = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, covered)
        names = ["doc_id", "first_line", "license", "reduction", "n_words", "missing", "extra"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            out = [(d, *f) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text")) for f in scanner.scan(t.as_py())]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    # A text without any of the rarest words holds no notice; by first letters, so that most words fail at once.
    by_letter: dict[str, list[str]] = {}
    for w in sorted(frozenset().union(*Scanner(templates, covered).rare.values())):
        by_letter.setdefault(w[0], []).append(re.escape(w[1:]))
    some_word = "(?i)(?<![a-z0-9])(?:" + "|".join(f"{re.escape(c)}(?:{'|'.join(rest)})" for c, rest in sorted(by_letter.items())) + ")"
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").rlike(some_word))
    return some.mapInArrow(run, "doc_id long, first_line long, license string, reduction double, n_words long, missing long, extra long")
