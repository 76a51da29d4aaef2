"""Licence statements and texts, found by the Dice coefficient over word bigrams.

Texts and licence templates are normalised alike: A-Z in lower case, ASCII marks as spaces. A stretch of words matches
a template when 2 * common / (own + template) distinct bigrams reaches a threshold. Stretches are of two kinds:

* units: lines, paragraphs of several lines, the whole text. A coefficient of t needs sizes within (2 - t) / t of each
  other, which leaves few templates per unit.
* windows of as many words as a template has, which find it between other words of a line, or with words changed.
  Running sums over the bigrams of one template bound what a window can share with it; only windows that begin with
  such a bigram and reach the bound are compared. Of overlapping matches the one with the highest coefficient stays,
  then the longest, the first, the first by identifier; windows that touch a matching unit do not count.

Texts that hold too few template bigrams for any match are never looked at one by one.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lossgrid.llm import words
from lossgrid.llm.arrow import batch, id_and_text, schema_with, small, utf8

THRESHOLD_PCT = 80

# Statements and notices as their publishers word them, by licence identifier.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
    ),
    "BSD-2-Clause": (
        "Licensed under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution.",
    ),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this "
        "work.",
        "Released under CC0 1.0 Universal Public Domain Dedication.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.",
    ),
    "LGPL-3.0": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    ),
}
#: Every licence can also be named by a tag.
TEMPLATES = {name: (*texts, f"SPDX-License-Identifier: {name}") for name, texts in TEMPLATES.items()}

#: Capitals in lower case, marks as spaces; line feeds stay.
PLAIN = bytes(
    c + 32 if 65 <= c < 91 else c if c >= 128 or chr(c).isalnum() or c == 10 else 32 for c in range(256)
)


def bigram_list(text: str) -> np.ndarray:
    """Bigram hashes of a normalised text, in order."""
    raw = text.encode().translate(PLAIN)
    return words.ngram_hashes(next(words.blocks([raw], len(raw) + 1)).hashes(), 2)


def bigrams(text: str) -> np.ndarray:
    """Sorted distinct bigram hashes of a normalised text."""
    return np.unique(bigram_list(text))


class Matcher:
    """Templates (of two words or more) by size, and all their bigrams."""

    def __init__(self, templates: Mapping[str, tuple[str, ...]], threshold_pct: int) -> None:
        listed = [(len(np.unique(b)), name, np.unique(b), len(b)) for name, texts in templates.items() for b in map(bigram_list, texts) if len(b)]
        listed.sort(key=lambda x: (x[0], x[1]))
        self.templates = [x[:3] for x in listed]
        self.lengths = [x[3] for x in listed]  # bigrams in order, repeats included
        self.sizes = np.array([n for n, _, _ in self.templates], np.int64)
        self.any = np.unique(np.concatenate([b for _, _, b in self.templates] or [np.empty(0, np.uint64)]))
        self.member = np.array([np.isin(self.any, b) for _, _, b in self.templates]).reshape(-1, len(self.any))
        self.pct = threshold_pct
        # The smallest template needs so many common bigrams with the smallest unit that can match it.
        smallest = int(self.sizes.min()) if len(self.sizes) else 0
        self.least = max(1, -(-threshold_pct * (smallest + self._low(smallest)) // 200))

    def _low(self, n: int) -> int:
        return -(-n * self.pct // (200 - self.pct))

    def best(self, own: np.ndarray) -> tuple[int, int, str] | None:
        """(common, sum of sizes, licence) of the best match; of equals the first by identifier."""
        n = len(own)
        # 2 * min / (own + template) >= t bounds the template size on both sides.
        low = np.searchsorted(self.sizes, self._low(n))
        high = np.searchsorted(self.sizes, n * (200 - self.pct) // self.pct, "right")
        found = None
        for size, name, other in self.templates[low:high]:
            common = len(np.intersect1d(own, other, assume_unique=True))
            if 200 * common >= self.pct * (n + size):
                key = (-common / (n + size), name)
                if found is None or key < found[0]:
                    found = (key, (common, n + size, name))
        return found[1] if found else None


    def windows(self, pairs: np.ndarray, free: np.ndarray) -> list[tuple[int, int, int, int, str]]:
        """(start, end, common, sum of sizes, licence) of the matching windows over the bigrams of a text, without
        overlaps, as word ranges; windows hold only bigrams that are ``free``."""
        if not len(self.any):
            return []
        at = np.minimum(np.searchsorted(self.any, pairs), len(self.any) - 1)
        known = np.flatnonzero((self.any[at] == pairs) & free)
        needs = [-(-self.pct * (n + self._low(n)) // 200) for n in self.sizes.tolist()]
        held = np.bincount(at[known], minlength=len(self.any))
        enough = np.flatnonzero((self.member & (held > 0)).sum(axis=1) >= needs)
        taken = np.concatenate([[0], np.cumsum(~free)]) if len(enough) else None
        found = []
        for k in enough.tolist():
            (size, name, other), length, need = self.templates[k], self.lengths[k], needs[k]
            places = known[self.member[k][at[known]]]
            # A window begins with a bigram of the template; towards the end of the text windows are cut short.
            ends = np.minimum(places + length, len(pairs))
            count = np.searchsorted(places, ends) - np.arange(len(places))
            some = (count >= need) & (taken[ends] == taken[places])
            for a, b in zip(places[some].tolist(), ends[some].tolist()):
                own = np.unique(pairs[a:b])
                common = len(np.intersect1d(own, other, assume_unique=True))
                if 200 * common >= self.pct * (len(own) + size):
                    found.append((-common / (len(own) + size), a - b, a, name, common, len(own) + size))
        found.sort()
        used = np.zeros(len(pairs) + 1, bool)
        kept = []
        for _, width, a, name, common, both in found:
            if not used[a : a - width + 1].any():
                used[a : a - width + 1] = True
                kept.append((a, a - width + 1, common, both, name))
        return kept


def units(block: words.Block, i: int) -> np.ndarray:
    """Word ranges (rows of first, end) of the lines with words of a text, of its paragraphs of several such lines,
    and of the whole text if it has several paragraphs. Paragraphs are divided by lines without words."""
    low, high = int(block.first[i]), int(block.first[i + 1])
    feeds = np.flatnonzero(block.data[block.text_starts[i] : block.text_ends[i]] == 10) + block.text_starts[i]
    line = np.searchsorted(feeds, block.starts[low:high])  # the line each word is in
    if not len(line):
        return np.empty((0, 2), np.int64)
    head = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
    lines = np.stack([head, np.append(head[1:], len(line))], axis=1) + low
    number = line[head]
    cut = np.flatnonzero(np.append(True, number[1:] - number[:-1] > 1))
    ends = np.append(cut[1:], len(number))
    several = ends - cut > 1
    blocks_of = np.stack([lines[cut, 0], lines[ends - 1, 1]], axis=1)
    whole = [[low, high]] if len(cut) > 1 else np.empty((0, 2), np.int64)
    return np.concatenate([lines, blocks_of[several], whole]).astype(np.int64)


def scan(
    docs: DataFrame,
    *,
    templates: Mapping[str, tuple[str, ...]] = TEMPLATES,
    threshold_pct: int = THRESHOLD_PCT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row: doc_id, n_matches, licenses, best_license, best_common, best_total, spans.

    ``licenses`` lists the distinct licences found, by identifier and joined by commas; ``best_license`` has the
    highest coefficient 2 * best_common / best_total. ``spans`` lists licence:start:end of the matching units and windows, from
    their first word to their last, in code points (end exclusive), by start, then longer first. NULL counts as ''; a
    text without a match has 0, '' and NULL for the best. Equal texts get equal results.
    """
    base = id_and_text(docs, id_col=id_col, text_col=text_col)

    def matches(block: words.Block, i: int, pairs: np.ndarray, total: np.ndarray, matcher: Matcher) -> tuple:
        ranges = units(block, i)
        several = ranges[ranges[:, 1] - ranges[:, 0] > 1]
        some = several[total[several[:, 1] - 1] - total[several[:, 0]] >= matcher.least]
        first, last = int(block.first[i]), int(block.first[i + 1])
        free = np.ones(max(last - first - 1, 0), bool)
        places = []
        for a, b in some.tolist():
            match = matcher.best(np.unique(pairs[a : b - 1]))
            if match:
                places.append((a, b, match))
                free[max(a - first - 1, 0) : b - first] = False
        for a, b, *match in matcher.windows(pairs[first : max(last - 1, first)], free):
            places.append((first + a, first + b, tuple(match)))
        if not places:
            return 0, "", None, None, None, ""
        own = block.data[block.text_starts[i] : block.text_ends[i]]
        lead = np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])
        begin = np.array([block.starts[a] for a, _, _ in places]) - block.text_starts[i]
        end = np.array([block.ends[b - 1] for _, b, _ in places]) - block.text_starts[i]
        found = [(int(lead[x]), -int(lead[y]), match) for x, y, (_, _, match) in zip(begin, end, places)]
        found.sort()
        best = min(found, key=lambda x: (-x[2][0] / x[2][1], x[2][2]))[2]
        return (
            len(found),
            ",".join(sorted({m[2] for _, _, m in found})),
            best[2],
            best[0],
            best[1],
            ",".join(f"{m[2]}:{a}:{-b}" for a, b, m in found),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(templates, threshold_pct)
        nothing = (0, "", None, None, None, "")
        names = ("n_matches", "licenses", "best_license", "best_common", "best_total", "spans")
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
        for part in small(batches):
            rows: list[tuple] = []
            for block in words.blocks([t.translate(PLAIN) for t in utf8(part.column(1))]):
                pairs = words.ngram_hashes(block.hashes(), 2)
                total = np.concatenate([[0], np.cumsum(np.isin(pairs, matcher.any)), [0, 0]])
                total[-2:] = total[-3]
                some = total[block.first[1:]] - total[block.first[:-1]] >= matcher.least
                rows += [matches(block, i, pairs, total, matcher) if some[i] else nothing for i in range(len(block.docs))]
            if rows:
                columns = {n: pa.array(c, k) for n, k, c in zip(names, kinds, zip(*rows))}
                yield batch({"doc_id": part.column(0), **columns})

    extra = "n_matches bigint, licenses string, best_license string, best_common bigint, best_total bigint, spans string"
    return base.mapInArrow(run, schema_with(base, ["doc_id"], extra))
