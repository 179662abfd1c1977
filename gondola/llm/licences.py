"""License scans (2): windows of a text against licence templates by Dice over word bigrams.

Texts are normalised to words of a-z, 0-9 and non-ASCII bytes, lower-cased; a window is any run of a text's
words, over line ends too. Its value for a template is 2 |A and B| / (|A| + |B|) over the sets of word
bigrams. At a Dice limit d a match holds at least d/(2-d) of the template's bigrams and has at most (2-d)/d
times as many; a text that lacks the first for a template is not looked at again.

For the rest all windows are compared, not a choice of sizes: a best window begins and ends with a bigram of
the template that it holds once at that end, as it could be shortened otherwise. So each such start is
followed up to the next time its bigram occurs, or to the size bound, with running counts of distinct
bigrams. A position is passed by at most as many starts as the template has bigrams.

Defined results: null and blank texts match nothing. Of equally good matches the first template (by name),
then the first line is named; a window that runs over a line end is line -1 and comes last. n_lines counts
the lines that hold a match of their own; repeated lines count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gondola.llm import words as W
from gondola.llm.common import by_batch
from gondola.llm.licence_texts import BODIES

LIMIT = 0.9

#: Published licence notices, by a name of the SPDX list (or "reserved").
NOTICES: dict[str, list[str]] = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License."],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies."
    ],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
        " to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "reserved": ["All rights reserved."],
}

#: Notices first, then bodies and file headers.
TEMPLATES = {name: NOTICES.get(name, []) + BODIES.get(name, []) for name in NOTICES | BODIES}


class Scanner:
    def __init__(self, templates: dict[str, list[str]], limit: float):
        self.limit, self.names, self.sets = limit, [], []
        for name in sorted(templates):
            for text in templates[name]:
                (run,) = W.runs(pa.array([text]), W.NOT_ALPHANUMERIC)
                own = np.unique(W.window_hashes(run.hashes, 2))
                if len(own):
                    self.names.append(name)
                    self.sets.append(own)
        every = np.concatenate(self.sets) if self.sets else np.empty(0, dtype=np.uint64)
        self.bigrams, code = np.unique(every, return_inverse=True)
        order = np.argsort(code, kind="stable")
        self.templates = np.repeat(np.arange(len(self.sets)), [len(own) for own in self.sets])[order]  # of each bigram
        self.first = np.searchsorted(code[order], np.arange(len(self.bigrams) + 1))
        # the fewest common bigrams and the most bigrams of a match, by the very division that decides
        self.least = np.array([1 + np.flatnonzero(2 * (c := np.arange(1, len(own) + 1)) / (c + len(own)) >= limit)[0] for own in self.sets], dtype=np.int64)
        self.most = [int(len(own) * (2 - limit) / limit) + 1 for own in self.sets]

    def candidates(self, hashes: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, template) pairs where the text holds enough of the template's bigrams, by text."""
        if not len(hashes) or not len(self.bigrams):
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        code = np.minimum(np.searchsorted(self.bigrams, hashes), len(self.bigrams) - 1)
        known = self.bigrams[code] == hashes
        text, code = np.divmod(np.unique(owner[known] * len(self.bigrams) + code[known]), len(self.bigrams))
        times = self.first[code + 1] - self.first[code]
        at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(self.first[code], times)
        pair, common = np.unique(np.repeat(text, times) * len(self.sets) + self.templates[at], return_counts=True)
        text, template = np.divmod(pair, len(self.sets))
        enough = common >= self.least[template]
        return text[enough], template[enough]

    def windows(self, text: _Text, k: int) -> Iterator[tuple[float, int]]:
        """(Dice, line) of the best window from each start that has one at the limit, in one line and over line ends."""
        own, size, most = np.isin(text.hashes, self.sets[k]), len(self.sets[k]), self.most[k]
        ahead = np.cumsum((own & (text.after == len(own)))[::-1])[::-1]  # distinct ones from here on
        for i in np.flatnonzero(own & (ahead >= self.least[k])):
            reach = 2 * most
            while True:
                stop = min(int(text.after[i]), i + reach)
                new = text.before[i:stop] < i
                distinct = np.cumsum(new)
                if distinct[-1] > most or stop < i + reach:
                    break
                reach *= 2
            ends = np.flatnonzero(new & own[i:stop])
            dice = 2 * np.arange(1, len(ends) + 1) / (distinct[ends] + size)
            alone = text.line[i + ends + 1] == text.line[i]
            for line, some in ((int(text.line[i]), dice[alone]), (-1, dice[~alone])):
                if len(some) and some.max() >= self.limit:
                    yield float(some.max()), line


class _Text:
    """The bigrams of a text: hashes, where each occurs before and after (-1 and their number if nowhere), lines of its words."""

    def __init__(self, hashes: np.ndarray, line: np.ndarray):
        self.hashes, self.line = hashes, line
        order = np.argsort(hashes, kind="stable")
        same = hashes[order[1:]] == hashes[order[:-1]]
        self.before, self.after = np.full(len(hashes), -1), np.full(len(hashes), len(hashes))
        self.before[order[1:][same]] = order[:-1][same]
        self.after[order[:-1][same]] = order[1:][same]


def _column(batch: pa.RecordBatch, text: str, scanner: Scanner) -> list[pa.Array]:
    n, best, dice, place, names = [], [], [], [], []
    for run in W.runs(batch.column(text), W.NOT_ALPHANUMERIC):
        hashes, at = W.windows(run, 2)
        bounds = np.searchsorted(at, run.first)
        breaks = np.concatenate([[0], np.cumsum(run.data == 0x0A)])
        found: dict[int, list[tuple[float, str, bool, int]]] = {}
        last, own = -1, None
        for t, k in zip(*(x.tolist() for x in scanner.candidates(hashes, run.owner[at], run.texts))):
            if t != last:
                line = breaks[run.starts[run.first[t] : run.first[t + 1]]] - breaks[run.offsets[t]]
                last, own = t, _Text(hashes[bounds[t] : bounds[t + 1]], line)
            found.setdefault(t, []).extend((-value, scanner.names[k], where < 0, where) for value, where in scanner.windows(own, k))
        for t in range(run.texts):
            all_ = found.get(t, [])
            top = min(all_, default=None)
            n.append(len({m[3] for m in all_ if not m[2]}))
            best.append(top and top[1])
            dice.append(top and -top[0])
            place.append(top and top[3])
            names.append(sorted({m[1] for m in all_}))
    return [pa.array(n, pa.int64()), pa.array(best, pa.string()), pa.array(dice, pa.float64()), pa.array(place, pa.int64()), pa.array(names, pa.list_(pa.string()))]


def scan(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, *, limit: float = LIMIT, text: str = "text", added: str = "licence") -> DataFrame:
    """The documents with a struct column `added`: n_lines (that match), name, dice and line of the best match, all names that match."""
    sent = docs.sparkSession.sparkContext.broadcast(Scanner(templates, limit))
    return by_batch(docs, added, "n_lines bigint, name string, dice double, line bigint, names array<string>", lambda batch: _column(batch, text, sent.value))
