"""License scans: matching statistics against a generalised suffix automaton of licence tokens.

Every text is streamed word by word through the automaton of all templates. The
state and length after a word are its matching statistic: the longest run of words
ending here that occurs in some template. Base phrases are read off the state
(a phrase ends here if its state is the current one or a suffix of it). So are the
statistics of each template by itself: the first state on the way up the suffix links
that ends in it. Maximal matches of a few words are chained per template, in template
order and with short gaps, and a chain covering enough of its template gives a span
and a label, unless another span over the same words covers more of them: a notice
with more conditions is not also one with fewer.

Defined results: a null or empty text has no words, no places, no labels and score 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.llm.common import ALNUM, alnum_words, with_result

# Phrases whose places are counted, with their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Published licence notices, as (label, notice).
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
            "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
            "furnished to do so, subject to the following conditions: The above copyright notice and this "
            "permission notice shall be included in all copies or substantial portions of the Software."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
               "except in compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in "
               "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
               "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation, either version 3 of the "
            "License, or (at your option) any later version. This program is distributed in the hope that it "
            "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
            "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met: Redistributions of source code must retain the "
            "above copyright notice, this list of conditions and the following disclaimer."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
                    "International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
            "rights to this work."),
    ("public-domain", "This work has been released into the public domain by its author. This applies worldwide."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
                  "modify, publish, use, compile, sell, or distribute this software, either in source code form or "
                  "as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
             "the License, or (at your option) any later version."),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
             "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
             "License, or (at your option) any later version."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
                 "License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
                 "License."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
            "the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
            "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
            "in all copies."),
]

LONG_MATCH = 3        # words a match needs to enter a chain
GAP = 12              # words of the text that a chain may skip between two matches
COVERED = 0.6         # share of a template that a chain must cover for a label

RESULT = ("n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
          "labels array<string>, score double, "
          "spans array<struct<label:string,template:int,start:long,end:long,share:double>>")


class SuffixAutomaton:
    """Of several word sequences; states know where in which sequence they end."""

    def __init__(self, sequences: list[list[bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for number, words in enumerate(sequences):
            last = 0
            for place, word in enumerate(words):
                last = self._extend(last, self.vocabulary.setdefault(word, len(self.vocabulary)))
                self.ends[last].add((number, place + 1))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            self.ends[self.link[state]] |= self.ends[state]
        self.ends[0] = set()

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.next) - 1

    def _split(self, parent: int, word: int, target: int) -> int:
        """A copy of ``target`` for the strings that reach it through ``parent``."""
        copy = self._state(self.length[parent] + 1, self.link[target], dict(self.next[target]))
        while parent >= 0 and self.next[parent].get(word) == target:
            self.next[parent][word] = copy
            parent = self.link[parent]
        self.link[target] = copy
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:       # the string so far also occurs in an earlier sequence
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        new = self._state(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            fits = self.length[target] == self.length[state] + 1
            self.link[new] = target if fits else self._split(state, word, target)
        return new

    def find(self, words: list[bytes]) -> int | None:
        state = 0
        for word in words:
            state = self.next[state].get(self.vocabulary.get(word, -1))
            if state is None:
                return None
        return state


class Scanner:
    """Matching statistics, phrase places and covered template spans of one text at a time."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES, long_match=LONG_MATCH, gap=GAP, covered=COVERED):
        self.templates = [(label, alnum_words(text)) for label, text in templates]
        self.phrases = [(alnum_words(text), label) for text, label in phrases]
        self.long_match, self.gap, self.covered = long_match, gap, covered
        self.automaton = a = SuffixAutomaton([w for _, w in self.templates] + [w for w, _ in self.phrases])
        own: dict[int, list[tuple[int, str]]] = {}
        for words, label in self.phrases:
            own.setdefault(a.find(words), []).append((len(words), label))
        self.ending: list[list[tuple[int, str]]] = [[] for _ in a.next]
        for state in sorted(range(1, len(a.next)), key=a.length.__getitem__):
            self.ending[state] = self.ending[a.link[state]] + own.get(state, [])
        # Template places of each state, without the bare phrases.
        self.places = [[e for e in ends if e[0] < len(self.templates)] for ends in a.ends]

    def statistics(self, words: list[bytes]):
        """(position, state, length) after each word that occurs in a template."""
        a = self.automaton
        moves, link, longest = a.next, a.link, a.length
        state = length = 0
        for i, word in enumerate(map(a.vocabulary.get, words)):
            if word is None:
                state = length = 0
                continue
            while word not in moves[state] and state:
                state = link[state]
                length = longest[state]
            state = moves[state].get(word, 0)
            length = length + 1 if state else 0
            if state:
                yield i, state, length

    def own_statistics(self, state: int, length: int):
        """(template, length, places) of each template whose words of at least ``long_match`` end here."""
        a, seen = self.automaton, set()
        while length >= self.long_match:
            by_template: dict[int, list[int]] = {}
            for template, place in self.places[state]:
                if template not in seen:
                    by_template.setdefault(template, []).append(place)
            for template, places in by_template.items():
                yield template, length, places
            seen.update(by_template)
            state = a.link[state]
            length = a.length[state]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, str]], list[tuple]]:
        """Places of base phrases, and each template's maximal long matches (start, end, template, places), by end."""
        bases, matches = [], []
        open_matches: dict[int, tuple] = {}     # template: the match that the next word may extend
        for i, state, length in self.statistics(words):
            for size, label in self.ending[state]:
                if size <= length:
                    bases.append((i + 1 - size, label))
            if length < self.long_match and not open_matches:
                continue
            still = {}
            for template, own, places in self.own_statistics(state, length):
                still[template] = (i + 1 - own, i + 1, template, places)
            for template, before in open_matches.items():
                now = still.get(template)
                if now is None or now[0] != before[0] or before[1] != i:
                    matches.append(before)
            open_matches = still
        matches += open_matches.values()
        return bases, sorted(matches, key=lambda m: (m[1], m[0], m[2]))

    def chains(self, matches: list[tuple]) -> list[tuple]:
        """Best chain ending at each match and template place; only those none goes on from.

        A chain looks back ``gap`` words, and two matches of a template cannot end at one word, so
        the work is linear in the matches.
        """
        recent: dict[int, list[list]] = {}      # template: [template, text end, template end, covered, text start, continued]
        done: list[list] = []
        for start, end, template, places in matches:
            still = []
            for link in recent.get(template, ()):
                (still if link[1] >= start - self.gap else done).append(link)
            made = []
            for place in places:
                length = end - start
                best = [template, end, place, length, start, False]
                for link in still:
                    # Overlapping matches count their common words once.
                    shift = max(0, link[1] - start)
                    if place - length + shift >= link[2] and link[1] < end:
                        if link[3] + length - shift > best[3]:
                            best[3], best[4] = link[3] + length - shift, link[4]
                            link[5] = True
                made.append(best)
            recent[template] = still + made
        return [c for c in [*done, *(link for own in recent.values() for link in own)] if not c[5]]

    def spans(self, matches: list[tuple]) -> tuple[list[dict], float]:
        """Chains that cover enough, and the largest share of any template covered."""
        found, score = {}, 0.0
        for template, end, _, count, start, _ in self.chains(matches):
            label, words = self.templates[template]
            share = min(1.0, count / len(words))
            score = max(score, share)
            if share >= self.covered:
                key = (template, end)
                if key not in found or found[key][0] < count:
                    found[key] = (count, {"label": label, "template": template, "start": start, "end": end,
                                          "share": share})
        # From the most words covered; a span that shares words with a larger one of another label goes.
        kept: list[tuple[int, dict]] = []
        for count, span in sorted(found.values(), key=lambda f: (-f[0], -f[1]["share"], f[1]["start"], f[1]["template"])):
            if not any(span["start"] < k["end"] and k["start"] < span["end"] and k["label"] != span["label"]
                       for _, k in kept):
                kept.append((count, span))
        return sorted((k for _, k in kept), key=lambda s: (s["start"], s["end"], s["template"])), score


def _start():
    scanner = Scanner()
    nothing = frozenset()

    def step(texts):
        rows = []
        for text in texts:
            words = (text or "").encode().translate(ALNUM).split()
            bases, matches = scanner.scan(words)
            spans, score = scanner.spans(matches) if matches else ([], 0.0)
            base = {label for _, label in bases} if bases else nothing
            rows.append((len(words), len(bases), min(bases)[0] if bases else None,
                         max(bases)[0] if bases else None, sorted(base),
                         sorted(base | {s["label"] for s in spans}), score, spans))
        return [list(column) for column in zip(*rows)] or [[]] * 8

    return step


def scan_licenses(docs: DataFrame, name: str, *, text: str = "text") -> DataFrame:
    """``docs`` with the struct ``name`` (RESULT): phrase places, labels, covered template spans."""
    return with_result(docs, [text], RESULT, _start, name)
