"""License notices found by token automata compiled from marked-up templates.

Markup: ``<<optional>> words <</optional>>`` may be absent, ``<<replace n>>`` stands
for up to n words of any wording; all other words must stand exactly as written.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame

from fareway.llm.common import PLAIN, id_and_text, map_rows, unkey

#: Phrases whose every place counts. Fixed values.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

#: Notices with markup: headers of files, leading sentences of whole licenses, titles. Fixed values.
TEMPLATES = (
    ("mit", "released under the <<optional>>terms of the<</optional>> mit license"),
    ("mit", "licensed under the <<optional>>terms of the<</optional>> mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this <<replace 2>>"
            " and associated documentation files the <<replace 2>> to deal in the <<replace 2>> without restriction"),
    ("apache-2", "licensed under the apache license version 2 0 <<optional>>the license<</optional>>"),
    ("apache-2", "you may obtain a copy of the license at <<optional>>http<</optional>> <<replace 1>> apache org licenses license 2 0"),
    ("apache-2", "apache license version 2 0 january 2004"),
    ("cc-by-nc", "licensed under <<optional>>a<</optional>> <<optional>>the<</optional>> cc by nc <<replace 1>> 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial <<replace 2>> <<optional>>international<</optional>> license"),
    ("cc-by-sa", "licensed under <<optional>>a<</optional>> <<optional>>the<</optional>> cc by sa"),
    ("cc-by-sa", "creative commons attribution sharealike <<replace 2>> <<optional>>international<</optional>> license"),
    ("cc-by", "creative commons attribution 4 0 international license"),
    ("cc0", "to the extent possible under law <<replace 6>> waived all copyright and related or neighboring rights"),
    ("gpl-2", "free software you can redistribute it and or modify it under the terms of the gnu general public license"
              " as published by the free software foundation <<optional>>either<</optional>> version 2"),
    ("gpl-2", "licensed under the gnu general public license version 2 <<optional>>or any later version<</optional>>"),
    ("gpl-2", "gnu general public license version 2 june 1991"),
    ("gpl-3", "licensed under the gnu general public license version 3 <<optional>>or any later version<</optional>>"),
    ("gpl-3", "under the terms of the gnu general public license as published by the free software foundation"
              " <<optional>>either<</optional>> version 3"),
    ("gpl-3", "gnu general public license version 3 29 june 2007"),
    ("agpl-3", "under the terms of the gnu affero general public license as published by the free software foundation"
               " <<optional>>either<</optional>> version 3"),
    ("lgpl", "gnu lesser general public license <<replace 4>> version <<replace 1>>"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"
             " <<optional>>either<</optional>> version <<replace 1>>"),
    ("lgpl-2.1", "under the terms of the gnu lesser general public license as published by the free software foundation"
                 " <<optional>>either<</optional>> version 2 1"),
    ("lgpl-3", "under the terms of the gnu lesser general public license as published by the free software foundation"
               " <<optional>>either<</optional>> version 3"),
    ("isc", "permission to use copy modify and <<optional>>or<</optional>> distribute this software for any purpose"
            " with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"
            " provided that the following conditions are met"),
    ("bsd", "licensed under <<optional>>the<</optional>> <<replace 1>> bsd license"),
    ("bsd-2", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"
              " <<replace 1>> redistributions in binary form must reproduce the above copyright notice this list of conditions and the"
              " following disclaimer in the documentation and or other materials provided with the distribution this software is provided"),
    ("bsd-3", "neither the name of <<replace 12>> may be used to endorse or promote products derived from this software"
              " without specific prior written permission"),
    ("mpl-2", "subject to the terms of the mozilla public license <<replace 1>> 2 0"),
    ("mpl-2", "mozilla public license version 2 0"),
    ("epl-2", "made available under the terms of the eclipse public license <<replace 1>> 2 0"),
    ("boost-1", "distributed under the boost software license version 1 0"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"
             " for any damages arising from the use of this software"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("reserved", "copyright <<replace 8>> all rights reserved"),
    ("proprietary", "proprietary and confidential <<optional>>all rights reserved<</optional>>"),
    ("mit", "spdx license identifier mit"),
    ("apache-2", "spdx license identifier apache 2 0"),
    ("gpl-2", "spdx license identifier gpl 2 0"),
    ("gpl-3", "spdx license identifier gpl 3 0"),
    ("bsd-2", "spdx license identifier bsd 2 clause"),
    ("bsd-3", "spdx license identifier bsd 3 clause"),
    ("mpl-2", "spdx license identifier mpl 2 0"),
    ("isc", "spdx license identifier isc"),
)

_ANY = None


class Automaton:
    """Nondeterministic token automaton of one template; its subset states are remembered as they are met."""

    def __init__(self, template: str):
        self.moves: list[list[tuple[str | None, int]]] = [[]]
        self.skips: list[list[int]] = [[]]
        self.mandatory: list[str] = []
        at, opened = 0, None
        for part in re.findall(r"<<[^>]*>>|[^\s<>]+", template):
            if part == "<<optional>>":
                if opened is not None:
                    raise ValueError("optional regions do not nest")
                opened = at
            elif part == "<</optional>>":
                if opened is None:
                    raise ValueError("an optional region ends that was not begun")
                self.skips[opened].append(at)
                opened = None
            elif part.startswith("<<replace"):
                n = int(part[9:-2])
                for _ in range(n):
                    at = self._step(at, _ANY, skip=True)
            else:
                if opened is None:
                    self.mandatory.append(part)
                at = self._step(at, part)
        if opened is not None:
            raise ValueError("an optional region does not end")
        self.final = at
        first = {w for s in self._closure({0}) for w, _ in self.moves[s]}
        if not self.mandatory or _ANY in first or self.final in self._closure({0}):
            raise ValueError("a template begins with a word and holds a mandatory one")
        self.first = frozenset(first)
        self.rare_first = sorted(set(self.mandatory), key=lambda w: (-len(w), w))
        self._next: dict[tuple[frozenset, str], frozenset] = {}
        self._begin = self._closure({0})
        self._words = {w for moves in self.moves for w, _ in moves}

    def _step(self, at: int, word: str | None, skip: bool = False) -> int:
        self.moves.append([])
        self.skips.append([])
        to = len(self.moves) - 1
        self.moves[at].append((word, to))
        if skip:
            self.skips[at].append(to)
        return to

    def _closure(self, states: Iterable[int]) -> frozenset:
        found, todo = set(states), list(states)
        while todo:
            for to in self.skips[todo.pop()]:
                if to not in found:
                    found.add(to)
                    todo.append(to)
        return frozenset(found)

    def _move(self, states: frozenset, word: str) -> frozenset:
        key = (states, word if word in self._words else "")
        if key not in self._next:
            reached = {to for s in states for w, to in self.moves[s] if w is _ANY or w == key[1]}
            self._next[key] = self._closure(reached)
        return self._next[key]

    def accepts_at(self, words: list[str], start: int) -> bool:
        """Does some run of words from ``start`` follow the template?"""
        states = self._begin
        for i in range(start, len(words)):
            states = self._move(states, words[i])
            if self.final in states:
                return True
            if not states:
                return False
        return False


def places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    """Every start of a phrase, overlapping ones included."""
    found, at = [], -1
    while True:
        try:
            at = words.index(phrase[0], at + 1)
        except ValueError:
            return found
        if words[at : at + len(phrase)] == phrase:
            found.append(at)


class LicenseScanner:
    def __init__(self, phrases=PHRASES, templates=TEMPLATES):
        self.phrases = [(label, phrase.encode().split()) for label, phrase in phrases]
        self.templates = []
        for label, template in templates:
            auto = Automaton(template)
            self.templates.append((label, auto, [w.encode() for w in auto.rare_first]))

    def scan(self, text: str) -> dict:
        flat = text.encode().translate(PLAIN)
        words = flat.split()
        starts, base = [], set()
        for label, phrase in self.phrases:
            if all(w in flat for w in phrase) and (found := places(words, phrase)):
                base.add(label)
                starts += found
        labels, accepted, decoded = set(base), False, None
        for label, auto, needed in self.templates:
            if all(w in flat for w in needed):
                if decoded is None:
                    decoded = [w.decode() for w in words]
                if any(auto.accepts_at(decoded, i) for i, w in enumerate(decoded) if w in auto.first):
                    labels.add(label)
                    accepted = True
        return {
            "n_words": len(words),
            "n_base": len(starts),
            "first_word": min(starts, default=None),
            "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(labels)),
            "score": 1.0 if accepted else 0.5 if base else 0.0,
        }


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
)


def scan_licenses(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """Phrases and templates found in each document's whole text, one row per row of ``docs``.

    A-Z are lower-cased; words are runs of letters, digits and non-ASCII characters.
    score is 1 if a template is accepted, 0.5 if only a phrase stands, else 0. Null
    and empty texts have no words, no labels and score 0; null ids stay null; repeated
    rows give equal rows; other columns are not read.
    """

    def run(batches):
        scanner = LicenseScanner(phrases, templates)
        for batch in batches:
            found = [scanner.scan(t.as_py() or "") for t in batch["text"]]
            names = [c.split()[0] for c in SCHEMA.split(", ")[1:]]
            yield {"doc_id": batch["doc_id"]} | {name: [f[name] for f in found] for name in names}

    return map_rows(id_and_text(docs), SCHEMA, run).withColumn("doc_id", unkey())
