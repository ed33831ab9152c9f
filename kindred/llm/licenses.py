"""Licence scans with a generalised suffix automaton.

The automaton holds every run of words of all templates. A text is streamed through it: at each word
the state tells the longest run ending there that stands in some template (matching statistics).
Long matches in one template that follow each other are chained into spans; the share of a template
that its spans cover decides on its label. Phrases are templates too: one occurs wherever the match
at a word is at least as long and its state descends from the phrase's.

The automaton has some thousand states and goes to the tasks with the function. Words are looked up by
hash, a pair of neighbours that stands in no template ends every match, so only the rest is streamed.
Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kindred.llm import bytesops as B
from kindred.llm.tables import keyed

# Phrases and templates with their labels. A run of words is credited to one template, so what a longer
# text has in common with a notice stands in the notice alone, and the rest of that text is a template of its own.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = {
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software",
        "Released under the MIT License",
        "and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
        "Licensed under the Apache License, Version 2.0",
    ],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version",
        "This work is licensed under the GNU General Public License, version 3",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        "1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright "
        "holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
        "CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
        "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
        "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
        "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
        "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0"],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version",
    ],
    "agpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version",
    ],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0 which is available at",
    ],
    "zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it "
        "freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; "
        "you must not claim that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source "
        "versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "3. This notice may not be removed or altered from any source distribution.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize "
        "copyright laws, the author or authors of this software dedicate any and all copyright interest in the "
        "software to the public domain. We make this dedication for the benefit of the public at large and to the "
        "detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
        "perpetuity of all present and future rights to this software under copyright law.",
    ],
    "boost": [
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
        "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to "
        "permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright "
        "notices in the Software and this entire statement, including the above license grant, this restriction and "
        "the following disclaimer, must be included in all copies of the Software, in whole or in part, and all "
        "derivative works of the Software, unless such copies or derivative works are solely in the form of "
        "machine-executable object code generated by a source language processor.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work",
    ],
}
MIN_MATCH = 4  # words of a match that is chained
MAX_GAP = 4  # words between two matches of a chain, in the text and in the template
MIN_SHARE = 0.6  # of a template's words for its label

_WORD = B.table(spans=((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)))
_LOWER = np.arange(256, dtype=np.uint8) + 32 * B.table(spans=((0x41, 0x5A),)).astype(np.uint8)


def _split(text: str) -> list[bytes]:
    texts = next(B.chunks(pa.array([text])))
    texts = texts._replace(data=_LOWER[texts.data])
    words, raw = B.words(texts, _WORD), texts.data.tobytes()
    return [raw[a:b] for a, b in zip(words.start.tolist(), words.end.tolist())]


class Match(NamedTuple):
    start: int
    length: int
    template: int
    at: int  # where the match starts in the template


class Automaton:
    """Generalised suffix automaton of the templates' word ids, and what streaming needs of it."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, list[str]]):
        self.phrases = [(_split(p), label) for p, label in phrases.items()]
        self.templates = [(_split(t), label) for label, texts in templates.items() for t in texts]
        runs = [w for w, _ in self.phrases] + [w for w, _ in self.templates]
        vocabulary = sorted({w for run in runs for w in run})
        ids = {w: i for i, w in enumerate(vocabulary)}
        joined = B.Texts(0, np.frombuffer(b"".join(vocabulary), np.uint8), np.cumsum([0] + [len(w) for w in vocabulary]))
        hashes = B.range_hashes(joined, joined.offsets[:-1], joined.offsets[1:])
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.pairs = np.zeros((len(vocabulary) + 1,) * 2, bool)
        self.next: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]  # (run, place of the last word)
        for number, run in enumerate(runs):
            last = 0
            for place, word in enumerate(run):
                last = self._extend(last, ids[word])
                self.ends[last].append((number, place))
                if place:
                    self.pairs[ids[run[place - 1]], ids[word]] = True
        self._spread_ends(len(self.phrases))

    def _extend(self, last: int, word: int) -> int:
        old = self.next[last].get(word)
        if old is not None:
            if self.longest[old] == self.longest[last] + 1:
                return old
            return self._clone(last, word, old)
        new = self._state(self.longest[last] + 1)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            old = self.next[at][word]
            self.link[new] = old if self.longest[old] == self.longest[at] + 1 else self._clone(at, word, old)
        return new

    def _state(self, longest: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.longest.append(longest)
        self.ends.append([])
        return len(self.next) - 1

    def _clone(self, at: int, word: int, old: int) -> int:
        """Split off the part of ``old`` that is reached by shorter runs."""
        new = self._state(self.longest[at] + 1)
        self.next[new], self.link[new] = dict(self.next[old]), self.link[old]
        self.link[old] = new
        while at >= 0 and self.next[at].get(word) == old:
            self.next[at][word] = new
            at = self.link[at]
        return new

    def _spread_ends(self, n_phrases: int) -> None:
        by_length = sorted(range(1, len(self.next)), key=lambda s: -self.longest[s])
        for state in by_length:
            if self.link[state] > 0:
                self.ends[self.link[state]] += self.ends[state]
        self.ends = [sorted(set(e)) for e in self.ends]
        self.hits: list[list[tuple[int, int]]] = [[] for _ in self.next]  # (phrase, its length)
        for phrase, (words, _) in enumerate(self.phrases):
            state = next(s for s in by_length if (phrase, len(words) - 1) in self.ends[s] and
                         self.longest[s] >= len(words) > self.longest[self.link[s]])
            for s in by_length:
                at = s
                while at > 0 and at != state:
                    at = self.link[at]
                if at == state:
                    self.hits[s].append((phrase, len(words)))

    def ids(self, texts: B.Texts, words: B.Words) -> np.ndarray:
        """The id of each word, that of no word where it is in no template."""
        hashes = B.range_hashes(texts, words.start, words.end)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], len(self.hashes))

    def stream(self, words: list[int]) -> tuple[list[int], list[int]]:
        """State and matching statistic after each word."""
        state = length = 0
        states, lengths = [], []
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.longest[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            states.append(state)
            lengths.append(length)
        return states, lengths


def _runs(automaton: Automaton, ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Stretches of two words or more in which all neighbours are neighbours in a template."""
    linked = automaton.pairs[ids[:-1], ids[1:]] & (doc[:-1] == doc[1:])
    linked = np.concatenate([[False], linked, [False]])
    low = np.flatnonzero(linked[1:] & ~linked[:-1])
    high = np.flatnonzero(linked[:-1] & ~linked[1:])
    return np.stack([low, high + 1], axis=1) if len(low) else np.zeros((0, 2), np.int64)


def _share(automaton: Automaton, template: int, matches: list[Match], max_gap: int) -> float:
    """The largest share of a template that one chain of matches covers."""
    best = 0
    chain: list[Match] = []
    covered: set[int] = set()
    for m in sorted(matches):
        if chain:
            gap = m.start - (chain[-1].start + chain[-1].length)
            shift = m.at - (chain[-1].at + chain[-1].length)
            if not (gap <= max_gap and -m.length < shift <= max_gap):
                chain, covered = [], set()
        chain.append(m)
        covered.update(range(m.at, m.at + m.length))
        best = max(best, len(covered))
    return best / len(automaton.templates[template][0])


def _batches(automaton: Automaton, min_match: int, max_gap: int, min_share: float, spans: bool):
    n_phrases = len(automaton.phrases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in B.chunks(batch.column("text")):
                texts = raw._replace(data=_LOWER[raw.data])
                words = B.words(texts, _WORD)
                ids = automaton.ids(texts, words)
                n = len(texts.offsets) - 1
                places: list[list[tuple[int, int]]] = [[] for _ in range(n)]
                matches: list[dict[int, list[Match]]] = [{} for _ in range(n)]
                for low, high in _runs(automaton, ids, words.doc).tolist():
                    doc = int(words.doc[low])
                    low_in_doc = low - int(words.offsets[doc])
                    states, lengths = automaton.stream(ids[low:high].tolist())
                    for i, (state, length) in enumerate(zip(states, lengths)):
                        for phrase, size in automaton.hits[state]:
                            if length >= size:
                                places[doc].append((low_in_doc + i + 1 - size, phrase))
                        if length >= min_match and (i + 1 == len(states) or lengths[i + 1] != length + 1):
                            for run_number, place in automaton.ends[state]:
                                t = run_number - n_phrases
                                if t >= 0:
                                    found = Match(low_in_doc + i + 1 - length, length, t, place + 1 - length)
                                    matches[doc].setdefault(t, []).append(found)
                columns: dict[str, list] = {k: [] for k in ("n_base", "first", "last", "base", "labels", "score", "spans")}
                for hits, by_template in zip(places, matches):
                    shares = {t: _share(automaton, t, m, max_gap) for t, m in by_template.items()}
                    base = {automaton.phrases[p][1] for _, p in hits}
                    own = {automaton.templates[t][1] for t, s in shares.items() if s >= min_share}
                    columns["n_base"].append(len(hits))
                    columns["first"].append(min(hits)[0] if hits else None)
                    columns["last"].append(max(hits)[0] if hits else None)
                    columns["base"].append(",".join(sorted(base)))
                    columns["labels"].append(",".join(sorted(base | own)))
                    columns["score"].append(1.0 if hits else max(shares.values(), default=0.0))
                    columns["spans"].append(
                        sorted({(m.start, m.start + m.length) for ms in by_template.values() for m in ms})
                    )
                out = {
                    "doc_id": batch.column("doc_id").slice(raw.first, n),
                    "n_words": pa.array(np.diff(words.offsets).astype(np.int64)),
                    "n_base": pa.array(columns["n_base"], pa.int64()),
                    "first_word": pa.array(columns["first"], pa.int64()),
                    "last_word": pa.array(columns["last"], pa.int64()),
                    "base_labels": pa.array(columns["base"], pa.string()),
                    "labels": pa.array(columns["labels"], pa.string()),
                    "score": pa.array(columns["score"], pa.float64()),
                }
                if spans:
                    flat = [[{"first": a, "end": b} for a, b in s] for s in columns["spans"]]
                    kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
                    out["spans"] = pa.array(flat, kind)
                yield pa.RecordBatch.from_pydict(out)

    return run


def scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, list[str]] = TEMPLATES,
    min_match: int = MIN_MATCH,
    max_gap: int = MAX_GAP,
    min_share: float = MIN_SHARE,
    spans: bool = True,
) -> DataFrame:
    """Every row of ``docs`` by doc_id with its phrases, labels, score and, if wanted, matched word spans.

    Words are runs of digits, letters (A-Z as a-z) and bytes of wider characters. ``n_base`` counts the
    places of phrases, ``labels`` adds those of templates of which a chain covers ``min_share``. The
    score is 1 with a phrase, else the largest share. A null text is empty; ids may be null or repeat, and every row is judged by itself. Texts
    may be of any length, other columns are ignored, whatever their names, and an empty table gives no rows.
    """
    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double"
    )
    automaton = Automaton(phrases, templates)
    return keyed(docs).select("doc_id", "text").mapInArrow(
        _batches(automaton, min_match, max_gap, min_share, spans),
        schema + ", spans array<struct<first: long, end: long>>" * spans,
    )
