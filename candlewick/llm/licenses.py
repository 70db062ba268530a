"""License scans by template markup.

A template is license wording with two kinds of region: ``[words]`` may be left out, and
``{min-max}`` stands for any ``min`` to ``max`` words (names, years). Every other word is
mandatory and must match exactly, in order, without gaps. Templates are compiled into one token
automaton, determinised while it runs; a text is scanned from every word that can begin a
template, and each accepted stretch is reported with the template's label. The longest stretch
counts for each label and start.

Texts are lower-cased (A-Z only) and cut into words of digits, letters a-z and all code points
from U+0080 on. Null and empty texts have no words and no matches; repeated rows and ties of
``doc_id`` are scanned like any other row; extra columns stay, and those named as an added
column are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, LongType, StringType,
                               StructField, StructType)

from candlewick.llm import common as C


@dataclass(frozen=True)
class Template:
    label: str
    markup: str
    base: bool = False


# Phrases and license wording. A label that ends in -text, -notice, -header or -conditions
# stands for that part of a license; -full for all of its mandatory wording.
BASE = (Template("mit", "mit license", True), Template("apache", "apache license", True),
        Template("gpl", "general public license", True))
TEMPLATES = BASE + (
    Template("mit-notice", "[released] [licensed] [distributed] under the [terms of the] mit license"),
    Template("mit-text", """permission is hereby granted free of charge to any person obtaining a copy of
        this software and associated documentation files the {1-3} to deal in {1-4} without restriction
        including without limitation the rights to use copy modify merge publish distribute sublicense and
        or sell copies of {1-4} and to permit persons to whom {1-4} is furnished to do so subject to the
        following conditions the above copyright notice and this permission notice [including the next
        paragraph] shall be included in all copies or substantial portions of {1-4}"""),
    Template("mit-text-full", """permission is hereby granted free of charge to any person obtaining a copy of
        this software and associated documentation files the {1-3} to deal in {1-4} without restriction
        including without limitation the rights to use copy modify merge publish distribute sublicense and
        or sell copies of {1-4} and to permit persons to whom {1-4} is furnished to do so subject to the
        following conditions the above copyright notice and this permission notice [including the next
        paragraph] shall be included in all copies or substantial portions of {1-4} the {1-3} is provided as is
        without warranty of any kind express or implied including but not limited to the warranties of
        merchantability fitness for a particular purpose and noninfringement in no event shall the
        authors or copyright holders be liable for any claim damages or other liability whether in an action
        of contract tort or otherwise arising from out of or in connection with {1-4} or the use or other
        dealings in {1-4}"""),
    Template("isc-text", """permission to use copy modify and or distribute this software for any purpose
        with or without fee is hereby granted provided that the above copyright notice and this permission
        notice appear in all copies"""),
    Template("bsd-text", """redistribution and use in source and binary forms with or without modification
        are permitted provided that the following conditions are met"""),
    Template("bsd-2-conditions", """redistribution and use in source and binary forms with or without
        modification are permitted provided that the following conditions are met [1] [a] redistributions of
        source code must retain the above copyright notice this list of conditions and the following
        disclaimer [2] [b] redistributions in binary form must reproduce the above copyright notice this list
        of conditions and the following disclaimer in the documentation and or other materials provided with
        the distribution"""),
    Template("bsd-3-conditions", """redistribution and use in source and binary forms with or without
        modification are permitted provided that the following conditions are met [1] [a] redistributions of
        source code must retain the above copyright notice this list of conditions and the following
        disclaimer [2] [b] redistributions in binary form must reproduce the above copyright notice this list
        of conditions and the following disclaimer in the documentation and or other materials provided with
        the distribution [3] [c] neither the name [s] of {1-20} nor the names of its contributors may be used
        to endorse or promote products derived from this software without specific prior written
        permission"""),
    Template("bsd-disclaimer", """this software is provided by {1-20} as is and any express or implied warranties
        including but not limited to the implied warranties of merchantability and fitness for a particular
        purpose are disclaimed"""),
    Template("bsd-3-clause", """neither the name [s] of {1-20} nor the names of its contributors may be used
        to endorse or promote products derived from this software without specific prior written
        permission"""),
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("apache-2.0", "apache license [v] [version] 2 0"),
    Template("apache-2.0-notice", """licensed under the apache license version 2 0 the license you may not use
        {1-4} except in compliance with the license"""),
    Template("apache-2.0-header", """licensed under the apache license version 2 0 the license you may not use
        {1-4} except in compliance with the license you may obtain a copy of the license at [http] [https] [www]
        apache org licenses license 2 0 unless required by applicable law or agreed to in writing software
        distributed under the license is distributed on an as is basis without warranties or conditions of any
        kind either express or implied see the license for the specific language governing permissions and
        limitations under the license"""),
    Template("zlib-text", """this software is provided as is without any express or implied warranty in no
        event will the {1-4} be held liable for any damages arising from the use of this software permission is
        granted to anyone to use this software for any purpose including commercial applications and to alter
        it and redistribute it freely subject to the following restrictions"""),
    Template("unlicense", """this is free and unencumbered software released into the public domain anyone is
        free to copy modify publish use compile sell or distribute this software either in source code form or
        as a compiled binary for any purpose commercial or non commercial and by any means"""),
    Template("bsl-1.0", "boost software license version 1 0"),
    Template("bsl-1.0-text", """permission is hereby granted free of charge to any person or organization obtaining
        a copy of the software and accompanying documentation covered by this license the software to use
        reproduce display distribute execute and transmit the software and to prepare derivative works of the
        software and to permit third parties to whom the software is furnished to do so all subject to the
        following"""),
    Template("mpl-2.0", "mozilla public license [v] [version] 2 0"),
    Template("mpl-2.0-notice", """this source code form is subject to the terms of the mozilla public license v 2 0 if
        a copy of the mpl was not distributed with this file you can obtain one at [http] [https] mozilla org mpl
        2 0"""),
    Template("cc0-1.0", "cc0 1 0 [universal]"),
    Template("cc0-notice", """to the extent possible under law {1-12} has waived all copyright and related or
        neighboring rights to"""),
    *(Template(f"{name}-{version.replace(' ', '.')}-or-later", f"""free software you can redistribute it and or modify it
        under the terms of the gnu {kind} general public license as published by the free software foundation
        either version {version} of the license or [at your option] any later version""")
      for name, kind, versions in (("gpl", "", ("2", "3")), ("lgpl", "lesser", ("2 1", "3")), ("agpl", "affero", ("3",)))
      for version in versions),
    Template("gpl-notice", """free software you can redistribute it and or modify it under the terms
        of the gnu [lesser] [library] [affero] general public license"""),
    Template("gpl-version", "gnu [lesser] [library] [affero] general public license [as published by the free "
                            "software foundation] [either] [v] [version] {1-1} [0] [or later]"),
    Template("gpl-named", "gnu [lesser] [library] [affero] general public license"),
    Template("spdx", "spdx license identifier {1-3}"),
)

WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
                   for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class TokenAutomaton:
    """All templates as one automaton over words.

    Positions of the nondeterministic automaton are numbers; ``steps[p]`` holds (word or None
    for any word, next position) and ``skips[p]`` positions that are reached without a word.
    """

    def __init__(self, templates: tuple[Template, ...]):
        self.templates = templates
        self.steps: list[list[tuple[bytes | None, int]]] = []
        self.skips: list[list[int]] = []
        self.ends: dict[int, int] = {}
        self.weight = []
        start = self._new()
        for k, t in enumerate(templates):
            first = self._new()
            self.skips[start].append(first)
            end, mandatory = self._region(first, re.findall(r"\[|\]|\{\d+-\d+\}|[^\s\[\]{}]+",
                                                            t.markup))
            self.ends[end] = k
            self.weight.append(mandatory)
        self.words = {w for s in self.steps for w, _ in s if w is not None}
        self.sets: dict[frozenset, int] = {}
        self.members: list[frozenset] = []
        self.found: list[tuple[int, ...]] = []
        self.next: list[dict[bytes | None, int]] = []
        self.first = self._state({start})
        begin = {w for p in self.members[self.first] for w, _ in self.steps[p]}
        if None in begin:
            raise ValueError("a template can't begin with a replaceable region")
        self.begin = frozenset(begin)

    def _new(self) -> int:
        self.steps.append([])
        self.skips.append([])
        return len(self.steps) - 1

    def _region(self, at: int, tokens: list[str]) -> tuple[int, int]:
        opened, mandatory = [], 0
        for token in tokens:
            if token == "[":
                opened.append(at)
            elif token == "]":
                self.skips[opened.pop()].append(at)
            elif token[0] == "{":
                least, most = map(int, token[1:-1].split("-"))
                stops = []
                for n in range(most):
                    if n >= least:
                        stops.append(at)
                    nxt = self._new()
                    self.steps[at].append((None, nxt))
                    at = nxt
                for stop in stops:
                    self.skips[stop].append(at)
            else:
                nxt = self._new()
                self.steps[at].append((token.encode(), nxt))
                at, mandatory = nxt, mandatory + (not opened)
        return at, mandatory

    def _state(self, positions: set[int]) -> int:
        todo, seen = list(positions), set(positions)
        while todo:
            for p in self.skips[todo.pop()]:
                if p not in seen:
                    seen.add(p)
                    todo.append(p)
        key = frozenset(seen)
        if key not in self.sets:
            self.sets[key] = len(self.members)
            self.members.append(key)
            self.found.append(tuple(sorted(self.ends[p] for p in key if p in self.ends)))
            self.next.append({})
        return self.sets[key]

    def step(self, state: int, word: bytes) -> int:
        """Next state, -1 if no template goes on."""
        letter = word if word in self.words else None
        to = self.next[state].get(letter)
        if to is None:
            reached = {n for p in self.members[state] for w, n in self.steps[p]
                       if w is None or w == letter}
            to = self.next[state][letter] = self._state(reached) if reached else -1
        return to

    def matches(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        """(start, end, template) of accepted stretches, the longest for each template."""
        if self.begin.isdisjoint(words):
            return []
        out = []
        for i in [i for i, w in enumerate(words) if w in self.begin]:
            state, best = self.first, {}
            for j in range(i, len(words)):
                state = self.step(state, words[j])
                if state < 0:
                    break
                for k in self.found[state]:
                    best[k] = j + 1
            out += [(i, end, k) for k, end in sorted(best.items())]
        return out


MATCH = StructType([StructField("label", StringType()), StructField("start", LongType()),
                    StructField("end", LongType()), StructField("base", BooleanType())])


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES,
         text_col: str = "text") -> DataFrame:
    """Append ``n_words``, ``license_matches`` (label, first word, end word, base or not) and
    ``license_score``: m / (m + 1) for the most mandatory words m that a match has, else 0."""
    fields = [StructField("n_words", LongType()),
              StructField("license_matches", ArrayType(MATCH)),
              StructField("license_score", DoubleType())]
    kind = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                      ("base", pa.bool_())])

    def make():
        automaton = TokenAutomaton(templates)

        def run(texts):
            sizes, found, scores = [], [], []
            for t in texts:
                words = words_of(t)
                m = automaton.matches(words)
                most = max((automaton.weight[k] for _, _, k in m), default=0)
                sizes.append(len(words))
                found.append([{"label": templates[k].label, "start": i, "end": e,
                               "base": templates[k].base} for i, e, k in m])
                scores.append(most / (most + 1))
            return [pa.array(sizes, pa.int64()), pa.array(found, pa.list_(kind)),
                    pa.array(np.array(scores, np.float64))]

        return run

    return C.with_text_columns(docs, text_col, fields, make)
