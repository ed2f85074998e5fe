"""Licence scan with a generalised suffix automaton of licence tokens.

The automaton holds all templates' words. A text is streamed through it and gives, for each word, the
longest stretch ending there that occurs in some template (its matching statistics). Long stretches are
chained, in text and template order, into spans; a template is reported where the chain covers enough of
it. Phrases are found exactly: a phrase ends at a word if it is an ending of that word's longest stretch.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import map_rows, utf8

common.ship(__name__)

# Phrases that give their label wherever they stand.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Public licence notices, shortened to their standard wording.
TEMPLATES = {
    "apache-2.0": [
        "licensed under the apache license version 2.0",
        "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license "
        "you may obtain a copy of the license at unless required by applicable law or agreed to in writing software distributed "
        "under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    ],
    "mit": [
        "licensed under the mit license",
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
        "files the software to deal in the software without restriction including without limitation the rights to use copy modify "
        "merge publish distribute sublicense and or sell copies of the software",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    ],
    "bsd": [
        "licensed under the bsd license",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
        "conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer",
    ],
    "isc": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "gpl": [
        "licensed under the gnu general public license",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
        "as published by the free software foundation either version of the license or at your option any later version",
    ],
    "lgpl": [
        "licensed under the gnu lesser general public license",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license",
    ],
    "mpl-2.0": [
        "this source code form is subject to the terms of the mozilla public license v 2.0",
    ],
    "cc-by": [
        "licensed under cc by 4.0",
        "this work is licensed under a creative commons attribution 4.0 international license",
    ],
    "cc-by-nc": [
        "licensed under cc by nc 4.0",
        "this work is licensed under a creative commons attribution noncommercial 4.0 international license",
    ],
    "cc-by-sa": [
        "licensed under cc by sa 4.0",
        "this work is licensed under a creative commons attribution sharealike 4.0 international license",
    ],
    "public-domain": [
        "this work is released into the public domain",
        "this is free and unencumbered software released into the public domain",
    ],
}

MIN_MATCH = 4
COVERAGE = 0.75
GAP = 12

# Bytes that may stand in a word after lower-casing A to Z; all others part words.
WORD_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words of ASCII letters, digits and anything beyond ASCII, with A to Z lower-cased."""
    return text.lower().translate(WORD_BYTES).split()


class Automaton:
    """Suffix automaton of several token sequences; no match runs from one sequence into another."""

    def __init__(self, templates: dict[str, list[str]], phrases: dict[str, str]) -> None:
        self.sequences = [(label, words_of(text.encode("utf-8"))) for label, texts in sorted(templates.items()) for text in texts]
        self.n_templates = len(self.sequences)
        named = [(label, words_of(phrase.encode("utf-8"))) for phrase, label in sorted(phrases.items())]
        vocabulary = sorted({w for _, words in [*self.sequences, *named] for w in words})
        self.ids = {w: i for i, w in enumerate(vocabulary)}
        self.tokens = [[self.ids[w] for w in words] for _, words in self.sequences]
        # A single word has no neighbour to be known by; it is looked for on its own.
        self.single = [(label, self.ids[words[0]]) for label, words in named if len(words) == 1]
        named = [(label, words) for label, words in named if len(words) > 1]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        # For each state all places (template number, position behind it) of its stretches.
        self.places: list[set[tuple[int, int]]] = [set()]
        self.follows = np.zeros((len(vocabulary), len(vocabulary)), dtype=bool)
        for number, (_, words) in enumerate([*self.sequences, *named]):
            last, tokens = 0, [self.ids[w] for w in words]
            self.follows[tokens[:-1], tokens[1:]] = True
            for position, token in enumerate(tokens, 1):
                last = self._extend(last, token)
                if number < self.n_templates:
                    self.places[last].add((number, position))
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                self.places[self.link[state]] |= self.places[state]
        # Phrases by the state of their own stretch; a longer stretch has them on its chain of links.
        ends: dict[int, list[tuple[str, int]]] = {}
        for label, words in named:
            state = 0
            for word in words:
                state = self.next[state][self.ids[word]]
            ends.setdefault(state, []).append((label, len(words)))
        self.phrases: list[list[tuple[str, int]]] = [[] for _ in self.next]
        for state in sorted(range(1, len(self.next)), key=lambda s: self.length[s]):
            self.phrases[state] = ends.get(state, []) + self.phrases[max(0, self.link[state])]

    def _extend(self, last: int, token: int) -> int:
        known = self.next[last].get(token)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, token, known)
        new = self._state(self.length[last] + 1)
        state = last
        while state >= 0 and token not in self.next[state]:
            self.next[state][token] = new
            state = self.link[state]
        if state < 0:
            self.link[new] = 0
        else:
            target = self.next[state][token]
            if self.length[target] == self.length[state] + 1:
                self.link[new] = target
            else:
                self.link[new] = self._split(state, token, target)
        return new

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(-1)
        self.length.append(length)
        self.places.append(set())
        return len(self.next) - 1

    def _split(self, state: int, token: int, target: int) -> int:
        """A state of its own for the shorter stretches of ``target``."""
        copy = self._state(self.length[state] + 1)
        self.next[copy] = dict(self.next[target])
        self.link[copy] = self.link[target]
        self.link[target] = copy
        while state >= 0 and self.next[state].get(token) == target:
            self.next[state][token] = copy
            state = self.link[state]
        return copy

    def statistics(self, tokens: list[int]) -> list[tuple[int, int]]:
        """For each token the state and the length of the longest stretch that ends there."""
        state = length = 0
        out = []
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.next[state]:
                state = self.next[state][token]
                length += 1
            else:
                state = length = 0
            out.append((state, length))
        return out

    def scan(self, tokens: np.ndarray, min_match: int, coverage: float, gap: int):
        """Phrase places (label, start) and template spans (label, start, words, share of the template)."""
        places: list[tuple[str, int]] = []
        matches: dict[int, list[tuple[int, int, int]]] = {}
        for label, token in self.single:
            places += [(label, at) for at in np.flatnonzero(tokens == token).tolist()]
        if len(tokens) > 1:
            # Only where neighbours also stand together in a template can a stretch of two or more be.
            beside = np.zeros(len(tokens) + 1, dtype=bool)
            beside[1:-1] = (tokens[:-1] >= 0) & (tokens[1:] >= 0) & self.follows[tokens[:-1], tokens[1:]]
            edges = np.flatnonzero(beside[1:] != beside[:-1])
            for begin, end in edges.reshape(-1, 2).tolist():
                run = tokens[begin : end + 1].tolist()
                for i, (state, length) in enumerate(self.statistics(run)):
                    for label, n in self.phrases[state]:
                        if length >= n:
                            places.append((label, begin + i + 1 - n))
                    if length >= min_match:
                        following = run[i + 1] if i + 1 < len(run) else -1
                        for number, position, n in self._ending(state, length, min_match, following):
                            matches.setdefault(number, []).append((begin + i + 1 - n, position - n, n))
        spans = [span for number, found in matches.items() for span in self._spans(number, found, coverage, gap)]
        return places, sorted(set(spans), key=lambda s: (s[1], s[0], s[2]))

    def _ending(self, state: int, length: int, min_match: int, following: int):
        """(template, position behind, words) of each longest common stretch that ends here and doesn't go on with the next word."""
        seen: set[tuple[int, int]] = set()
        while state > 0 and length >= min_match:
            for number, position in self.places[state] - seen:
                words = self.tokens[number]
                if position == len(words) or words[position] != following:
                    yield number, position, length
            seen |= self.places[state]
            state = self.link[state]
            length = self.length[state]

    def _spans(self, number: int, matches: list[tuple[int, int, int]], coverage: float, gap: int):
        """Spans of the best chains of (start in the text, place in the template, words).

        A chain goes forward in both; of a match that overlaps the one before, only the rest counts. For every match the
        best chain that ends with it is known, then chains are taken by the words they cover, largest first, where
        no chain taken before lies.
        """
        label, words = self.sequences[number]
        ordered = sorted(matches)
        covered, begins = [n for _, _, n in ordered], [start for start, _, _ in ordered]
        for x, (start, place, n) in enumerate(ordered):
            for y in range(x - 1, -1, -1):
                before, at, m = ordered[y]
                # No match is longer than the template.
                if before + len(words) + gap < start:
                    break
                over = max(0, before + m - start, at + m - place)
                if at < place and before < start and over < n and start + over - before - m <= gap and covered[y] + n - over > covered[x]:
                    covered[x], begins[x] = covered[y] + n - over, begins[y]
        taken: list[tuple[int, int]] = []
        for x in sorted(range(len(ordered)), key=lambda x: (-covered[x], begins[x], ordered[x])):
            share = covered[x] / len(words)
            if share < coverage:
                break
            begin, end = begins[x], ordered[x][0] + ordered[x][2]
            if not any(begin < e and b < end for b, e in taken):
                taken.append((begin, end))
                yield label, begin, end - begin, min(1.0, share)


SPANS = (
    "doc_id long, n_words long, phrases array<struct<label string, start long>>, "
    "spans array<struct<label string, start long, words long, coverage double>>"
)


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, list[str]] | None = None,
    phrases: dict[str, str] | None = None,
    min_match: int = MIN_MATCH,
    coverage: float = COVERAGE,
    gap: int = GAP,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Phrase places and template spans of whole texts, in word numbers from 0; one row per row of ``docs``.

    Stretches shorter than ``min_match`` words don't count towards a template; stretches of a chain are at
    most ``gap`` words apart, and a chain counts if it covers the share ``coverage`` of the template. A missing or empty text has no words and empty lists. Repeated rows and
    missing ids stay as they are; other columns are ignored.
    """
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    automaton = Automaton(templates, phrases)

    def work(rows: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": rows["doc_id"], "n_words": [], "phrases": [], "spans": []}
        known = automaton.ids
        for raw in rows["text"]:
            words = words_of(raw)
            tokens = np.array([known.get(w, -1) for w in words], dtype=np.int64)
            places, spans = automaton.scan(tokens, min_match, coverage, gap)
            out["n_words"].append(len(words))
            out["phrases"].append([{"label": a, "start": b} for a, b in sorted(places, key=lambda p: (p[1], p[0]))])
            out["spans"].append([{"label": a, "start": b, "words": c, "coverage": d} for a, b, c, d in spans])
        return out

    return map_rows(
        docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), utf8(text_column).alias("text")), work, SPANS
    )
