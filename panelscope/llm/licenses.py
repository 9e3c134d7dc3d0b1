"""Licence scan with a generalised suffix automaton of licence tokens (operator 11).

Automaton. The words of all templates make one suffix automaton; a state stands for the word sequences that end at the same
places of the templates. Words that no template has lead to the start. The table of transitions is closed: from each state and word it
holds the state that is reached after following suffix links, and the length that is left of the match. It is bounded by the templates.

Matching statistics. A text is streamed through the automaton in blocks of bytes that end between words, with state and length carried from block to
block: after each word, the longest word sequence ending there that some template has. Words are looked up by hash and compared byte by byte. Runs
of template words are stepped side by side, one table lookup a word.

Spans. A match that the next word does not extend, of ``min_match`` words or more, is placed in each template where its state ends. Matches that
follow one another in text and template, with at most ``max_gap`` words between them, are chained; a chain's coverage is the share of the template's
words in its matches. Chains of at least ``min_coverage`` are spans of the template's licence. Phrases are short templates of their own: a phrase stands wherever
a state's word sequence ends with it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelscope.llm.shingles import U64, _powers, mix, slices
from panelscope.llm.worker import kept

#: Phrases (fixed values) and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Notices and texts of public licences (fixed values): (label, text). Places for names and years are left out.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT License."),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
        furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in
        all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
        IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
        EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
        TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed
        to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is
        distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS
        FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public
        License along with this program. If not, see <https://www.gnu.org/licenses/>."""),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public
        License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."""),
    ("agpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
        disclaimer in the documentation and/or other materials provided with the distribution."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
        that the above copyright notice and this permission notice appear in all copies."""),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
        with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
        compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
        non-commercial, and by any means."""),
]
#: Bytes of text that a step takes together; longer texts are carried over blocks.
BLOCK_BYTES = 1 << 20

#: Word bytes: digits, letters, and all bytes of other characters.
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def words_of(text: str) -> list[str]:
    """The words of a template or phrase."""
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


class Rules(NamedTuple):
    templates: Sequence[tuple[str, str]] = tuple(TEMPLATES)
    phrases: Mapping[str, str] = PHRASES
    min_match: int = 3
    max_gap: int = 6
    min_coverage: float = 0.8


class Automaton:
    """Generalised suffix automaton of word sequences, with its closed transition table.

    ``step[v, w]`` is the state after word w, ``left[v, w]`` what remains of the match's length before w (-1: all of it).
    """

    def __init__(self, sequences: list[list[str]]):
        self.vocabulary = sorted({w for s in sequences for w in s})
        number = {w: k for k, w in enumerate(self.vocabulary)}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, s in enumerate(sequences):
            v = 0
            for k, w in enumerate(s):
                v = self._extend(v, number[w])
                ends[v].append((t, k + 1))
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True)
        for v in order:  # a state ends wherever the states that link to it end
            if self.link[v] > 0:
                ends[self.link[v]] += ends[v]
        #: (template, words up to the end) of every place where a state ends
        self.ends = {v: sorted(e) for v, e in ends.items()}
        n, m = len(self.length), len(self.vocabulary)
        self.step, self.left = np.zeros((n, m + 1), np.int32), np.zeros((n, m + 1), np.int32)
        for v in [0, *reversed(order)]:
            if v:
                self.step[v] = self.step[self.link[v]]
                at = self.left[self.link[v]]
                self.left[v] = np.where(at < 0, self.length[self.link[v]], at)
            for w, to in self.next[v].items():
                self.step[v, w], self.left[v, w] = to, -1
        self.step[:, m], self.left[:, m] = 0, 0  # a word of no template; its length is set to 0

    def _copy(self, v: int, w: int) -> int:
        to = self.next[v][w]
        if self.length[to] == self.length[v] + 1:
            return to
        new = len(self.length)
        self.next.append(dict(self.next[to]))
        self.length.append(self.length[v] + 1)
        self.link.append(self.link[to])
        self.link[to] = new
        while v >= 0 and self.next[v].get(w) == to:
            self.next[v][w] = new
            v = self.link[v]
        return new

    def _extend(self, v: int, w: int) -> int:
        if w in self.next[v]:
            return self._copy(v, w)
        new = len(self.length)
        self.next.append({})
        self.length.append(self.length[v] + 1)
        self.link.append(0)
        while v >= 0 and w not in self.next[v]:
            self.next[v][w] = new
            v = self.link[v]
        if v >= 0:
            self.link[new] = self._copy(v, w)
        return new


class Match(NamedTuple):
    """Words ``start`` to ``start + length`` of a text are words ``at`` to ``at + length`` of a template."""

    start: int
    at: int
    length: int


def chains(matches: list[Match], max_gap: int) -> list[tuple[int, int, int]]:
    """(first word, word behind the last, template words covered) of the best chains of one template, none sharing a match's end.

    ``matches`` are in order of their ends in the text. A match follows another if it ends behind it in text and template and begins at most ``max_gap``
    words behind its end in both; of what overlaps only the rest counts. Each match takes the predecessor that covers most. Only matches whose ends are within
    the longest match and the gap are looked at, so the cost is linear in the text.
    """
    if not matches:
        return []
    longest = max(m.length for m in matches)
    best: list[tuple[int, int, int]] = []  # covered, predecessor, first word
    low = 0
    for k, m in enumerate(matches):
        end, t_end = m.start + m.length, m.at + m.length
        while matches[low].start + matches[low].length < end - longest - max_gap:
            low += 1
        top = (m.length, -1, m.start)
        for j in range(low, k):
            p = matches[j]
            p_end, q_end = p.start + p.length, p.at + p.length
            if p_end < end and q_end < t_end and m.start - p_end <= max_gap and m.at - q_end <= max_gap:
                rest = min(m.length, end - p_end, t_end - q_end)
                if best[j][0] + rest > top[0]:
                    top = (best[j][0] + rest, j, best[j][2])
        best.append(top)
    used = {b[1] for b in best}
    return [(b[2], matches[k].start + matches[k].length, b[0]) for k, b in enumerate(best) if k not in used]


class Scanner:
    """The automaton of some rules, and the state of a stream of words."""

    def __init__(self, rules: Rules):
        self.rules = rules
        self.phrases = [words_of(p) for p in rules.phrases]
        self.templates = [words_of(t) for _, t in rules.templates]
        a = self.automaton = Automaton(self.templates + self.phrases)
        first = len(self.templates)
        self.min_phrase = min(map(len, self.phrases), default=1 << 30)
        # phrases that a state's longest sequence ends with
        self.says: dict[int, list[int]] = {}
        state_of = {}
        for k, p in enumerate(self.phrases):
            v = 0
            for w in p:
                v = a.next[v][a.vocabulary.index(w)]
            state_of[k] = v
        for v in range(1, len(a.length)):
            at, found = v, []
            while at > 0:
                found += [k for k, s in state_of.items() if s == at]
                at = a.link[at]
            if found:
                self.says[v] = found
        self.speaking = np.zeros(len(a.length), bool)
        self.speaking[list(self.says)] = True
        #: places of each state in templates
        self.places = {v: [(t, k) for t, k in e if t < first] for v, e in a.ends.items()}
        raw = [w.encode() for w in a.vocabulary]
        hashes = np.array([_hash(w) for w in raw], U64)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], order
        self.widest = max(map(len, raw), default=0)
        self.bytes = np.zeros((len(raw) + 1, self.widest), np.uint8)
        for k, w in enumerate(raw):
            self.bytes[k, :len(w)] = np.frombuffer(w, np.uint8)
        self.sizes = np.array([len(w) for w in raw] + [0])
        self.none = len(raw)

    def numbered(self, lower: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The vocabulary number of each word, compared byte by byte; the number behind the last for other words."""
        size = last - first
        up, down = _powers(len(lower) + 1)
        sums = np.zeros(len(lower) + 1, U64)
        np.cumsum((lower.astype(U64) + U64(1)) * up[:len(lower)], out=sums[1:])
        hashes = mix((sums[last] - sums[first]) * down[first] + size.astype(U64))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        out = np.where(self.hashes[at] == hashes, self.numbers[at], self.none)
        hit = np.flatnonzero(out != self.none)
        same = size[hit] == self.sizes[out[hit]]
        hit, wrong = hit[same], hit[~same]
        out[wrong] = self.none
        ok = np.ones(len(hit), bool)
        for k in range(int(size[hit].max(initial=0))):
            longer = size[hit] > k
            ok[longer] &= lower[first[hit[longer]] + k] == self.bytes[out[hit[longer]], k]
        out[hit[~ok]] = self.none
        return out

    def stream(self, numbers: np.ndarray, heads: np.ndarray, carried: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """(state, length) after each word; texts begin at ``heads``, the first goes on from ``carried`` if it is not a head."""
        n = len(numbers)
        state, length = np.zeros(n, np.int32), np.zeros(n, np.int32)
        known = numbers != self.none
        begin = known.copy()
        begin[1:] &= ~known[:-1]
        begin[heads[heads < n]] |= known[heads[heads < n]]
        starts = np.flatnonzero(begin)
        cut = np.flatnonzero(~known | begin)
        ends = np.append(cut, n)[np.searchsorted(cut, starts, "right")]
        s, l_ = np.zeros(len(starts), np.int32), np.zeros(len(starts), np.int32)
        if len(starts) and starts[0] == 0 and not (len(heads) and heads[0] == 0):
            s[0], l_[0] = carried
        order = np.argsort(starts - ends, kind="stable")  # long runs first: those still running are a prefix
        starts, ends, s, l_ = starts[order], ends[order], s[order], l_[order]
        size = ends - starts
        k, live = 0, len(starts)
        a = self.automaton
        while live:
            live = int(np.searchsorted(-size, -k, "left"))
            if not live:
                break
            at = starts[:live] + k
            w = numbers[at]
            left = a.left[s[:live], w]
            l_[:live] = np.where(left < 0, l_[:live], left) + 1
            s[:live] = a.step[s[:live], w]
            l_[:live][s[:live] == 0] = 0
            state[at], length[at] = s[:live], l_[:live]
            k += 1
        return state, length


def _hash(word: bytes) -> np.uint64:
    raw = np.frombuffer(word, np.uint8)
    up, _ = _powers(len(raw) + 1)
    with np.errstate(over="ignore"):
        return mix(np.array([((raw.astype(U64) + U64(1)) * up[:len(raw)]).sum(dtype=U64) + U64(len(raw))], U64))[0]


class Found:
    """What has been seen of one text."""

    def __init__(self):
        self.n = 0
        self.phrases: list[tuple[int, int]] = []  # (first word, phrase)
        self.matches: dict[int, list[Match]] = defaultdict(list)  # by template
        self.state = self.length = 0  # after the last word

    def match(self, scanner: Scanner, state: int, length: int, end: int) -> None:
        if length >= scanner.rules.min_match:
            for t, k in scanner.places.get(state, ()):
                self.matches[t].append(Match(end - length, k - length, length))


def _blocks(texts: Iterable[bytes]) -> Iterator[tuple[list[tuple[int, bool]], bytes]]:
    """Blocks of about BLOCK_BYTES, cut between words: the texts in each, with whether they begin there, and the bytes.

    A text of more bytes has blocks of its own.
    """
    held, size, parts = [], 0, []  # bytes of several texts have a space behind each
    for k, data in enumerate(texts):
        at = 0
        while len(data) - at > BLOCK_BYTES:
            end = at + BLOCK_BYTES
            while end < len(data) and _WORD[data[end - 1]] and _WORD[data[end]]:
                end += 1
            if held:
                yield held, b"".join(parts)
                held, size, parts = [], 0, []
            yield [(k, at == 0)], data[at:end]
            at = end
        if held and size + len(data) - at > BLOCK_BYTES:
            yield held, b"".join(parts)
            held, size, parts = [], 0, []
        held.append((k, at == 0))
        parts.append(data[at:] + b" ")
        size += len(data) - at + 1
        if at:  # the end of a long text is a block of its own, so that its state is carried
            yield held, b"".join(parts)
            held, size, parts = [], 0, []
    if held:
        yield held, b"".join(parts)


def scan(scanner: Scanner, texts: Sequence[str | None]) -> list[Found]:
    """What each text has; a null is an empty text."""
    data = [(t or "").encode() for t in texts]
    out = [Found() for _ in data]
    for members, block in _blocks(data):
        raw = np.frombuffer(block, np.uint8)
        lower = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
        edge = np.diff(_WORD[raw].astype(np.int8), prepend=0, append=0)
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        n = len(first)
        if n == 0:
            continue
        ends = np.cumsum([len(data[k]) + 1 for k, _ in members])
        bounds = np.concatenate([[0], np.searchsorted(first, ends)]) if len(members) > 1 else np.array([0, n])
        goes_on = not members[0][1]  # a text carried over from the block before
        carried = out[members[0][0]]
        state, length = scanner.stream(scanner.numbered(lower, first, last), np.unique(bounds[1 if goes_on else 0:-1]), (carried.state, carried.length))
        if goes_on and length[0] != carried.length + 1:
            carried.match(scanner, carried.state, carried.length, carried.n)
        # where the next word does not extend the match; the last word of a block of one text waits for the next block
        stops = np.ones(n, bool)
        stops[:-1] = length[1:] != length[:-1] + 1
        stops[bounds[1:-1][bounds[1:-1] > 0] - 1] = True
        stops[n - 1] = len(members) > 1
        spoken = np.flatnonzero(scanner.speaking[state] & (length >= scanner.min_phrase))
        for i, m in zip(spoken.tolist(), (np.searchsorted(bounds, spoken, "right") - 1).tolist()):
            found = out[members[m][0]]
            end = found.n + i - int(bounds[m]) + 1
            found.phrases += [(end - len(scanner.phrases[p]), p) for p in scanner.says[int(state[i])] if len(scanner.phrases[p]) <= length[i]]
        ended = np.flatnonzero(stops & (length >= scanner.rules.min_match))
        for i, m in zip(ended.tolist(), (np.searchsorted(bounds, ended, "right") - 1).tolist()):
            found = out[members[m][0]]
            found.match(scanner, int(state[i]), int(length[i]), found.n + i - int(bounds[m]) + 1)
        for m, (k, _) in enumerate(members):
            out[k].n += int(bounds[m + 1] - bounds[m])
        if len(members) == 1:
            carried.state, carried.length = int(state[-1]), int(length[-1])
    for found in out:  # what the last word of a text in blocks of its own left waiting
        found.match(scanner, found.state, found.length, found.n)
    return out


class Span(NamedTuple):
    """Words ``first_word`` to ``end_word`` (excluded) of a text hold ``covered`` words of a template, a share of ``coverage``."""

    label: str
    template: int
    first_word: int
    end_word: int
    covered: int
    coverage: float


def spans(scanner: Scanner, found: Found) -> tuple[list[Span], float]:
    """The spans of a text by place, and the highest coverage of any chain.

    Of chains that overlap the one that covers most words is a span; ties go to the higher coverage, the earlier place, the earlier template.
    """
    every = []
    for t, matches in found.matches.items():
        n = len(scanner.templates[t])
        every += [Span(scanner.rules.templates[t][0], t, a, b, c, c / n) for a, b, c in chains(matches, scanner.rules.max_gap)]
    score = max((s.coverage for s in every), default=0.0)
    taken: list[Span] = []
    for s in sorted((s for s in every if s.coverage >= scanner.rules.min_coverage), key=lambda s: (-s.covered, -s.coverage, s.first_word, s.template)):
        k = bisect_left(taken, s.first_word, key=lambda x: x.first_word)
        if (k == 0 or taken[k - 1].end_word <= s.first_word) and (k == len(taken) or taken[k].first_word >= s.end_word):
            taken.insert(k, s)
    return taken, score


def _scanned(docs: DataFrame, rules: Rules, id_col: str, text_col: str, schema: str, rows) -> DataFrame:
    types = pa.schema([(f.name, {"long": pa.int64(), "bigint": pa.int64(), "double": pa.float64()}.get(f.dataType.simpleString(), pa.string()))
                       for f in _parse(schema)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = kept("licence scanner", repr(rules), lambda: Scanner(rules))
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                ids, texts = (batch.column(c).slice(lo, hi - lo).to_pylist() for c in range(2))
                out = [r for id_, found in zip(ids, scan(scanner, texts)) for r in rows(scanner, id_, found)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), types)], schema=types)

    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _parse(schema: str):
    return StructType.fromDDL(schema).fields


def license_spans(docs: DataFrame, rules: Rules = Rules(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, label, template, first_word, end_word, covered, coverage): a row for each span; edge cases as in ``license_report``."""
    return _scanned(docs, rules, id_col, text_col, "id long, label string, template long, first_word long, end_word long, covered long, coverage double",
                    lambda scanner, id_, found: [(id_, *s) for s in spans(scanner, found)[0]])


def license_report(docs: DataFrame, rules: Rules = Rules(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of each document.

    ``n_base`` counts the places of phrases, ``first_word`` and ``last_word`` are the smallest and largest word where one starts (null without any),
    ``labels`` are the phrases' labels and those of spans, ``score`` the highest coverage of a template by a chain of matches.

    Null and empty texts have no words: zeros, nulls and empty labels. Repeated rows and ids, and null ids, stay as they are; other columns are not
    used, whatever their names. Texts are whole, whatever their length. No rows give none.
    """
    names = list(rules.phrases.values())

    def rows(scanner: Scanner, id_: int | None, found: Found):
        taken, score = spans(scanner, found)
        at = [a for a, _ in found.phrases]
        base = {names[p] for _, p in found.phrases}
        yield (id_, found.n, len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
               ",".join(sorted(base | {s.label for s in taken})), score)

    return _scanned(docs, rules, id_col, text_col, "id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double", rows)
