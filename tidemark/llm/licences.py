"""Licence scans: matching statistics against a generalised suffix automaton of licence notices."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, table

#: Phrases that decide a label by themselves.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Notices by label; any list of (label, text) can be scanned for.
NOTICES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
            "Free Software Foundation"),
    ("lgpl", "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
)
#: Words of a match that counts, words of a text between matches of one chain, and the share that makes a label.
MATCH, GAP, SHARE = 4, 12, 0.75
#: ASCII digits and lower-case letters, and every byte of other characters.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
ROWS = 500


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


class Automaton:
    """Generalised suffix automaton of token sequences.

    ``step`` extends a match by a token or falls back along suffix links, so that after each token of a text the state
    stands for the longest suffix read that occurs in some template, and ``length`` is that suffix's length.
    """

    def __init__(self, templates: list[tuple[str, list[bytes]]], phrases: dict[tuple[bytes, ...], str]):
        self.labels = [label for label, _ in templates]
        self.sizes = [len(words) for _, words in templates]
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.long = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        coded = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] for _, words in templates]
        for number, sequence in enumerate(coded):
            last = 0
            for place, token in enumerate(sequence):
                last = self._extend(last, token)
                while len(ends) < len(self.next):
                    ends.append(set())
                ends[last].add((number, place))
        order = sorted(range(1, len(self.next)), key=self.long.__getitem__, reverse=True)
        for state in order:
            ends[self.link[state]] |= ends[state]
        #: Where a state's sequences end: (template, place of the last token).
        self.ends = [tuple(sorted(e)) for e in ends]
        self.phrases: list[tuple[tuple[int, str], ...]] = [()] * len(self.next)
        for phrase, label in phrases.items():
            state = 0
            for word in phrase:
                state = self.next[state][self.vocabulary[word]]
            self.phrases[state] += ((len(phrase), label),)
        for state in sorted(range(1, len(self.next)), key=self.long.__getitem__):
            self.phrases[state] += self.phrases[self.link[state]]
        #: Words of the shortest thing worth a look.
        self.least = min([MATCH, *map(len, phrases)])

    def _extend(self, last: int, token: int) -> int:
        known = self.next[last].get(token)
        if known is not None:
            if self.long[known] == self.long[last] + 1:
                return known
            return self._clone(last, token, known)
        state = self._new(self.long[last] + 1)
        at = last
        while at >= 0 and token not in self.next[at]:
            self.next[at][token] = state
            at = self.link[at]
        if at < 0:
            self.link[state] = 0
        else:
            other = self.next[at][token]
            self.link[state] = other if self.long[other] == self.long[at] + 1 else self._clone(at, token, other)
        return state

    def _new(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.long.append(length)
        return len(self.next) - 1

    def _clone(self, at: int, token: int, other: int) -> int:
        state = self._new(self.long[at] + 1)
        self.next[state] = dict(self.next[other])
        self.link[state] = self.link[other]
        self.link[other] = state
        while at >= 0 and self.next[at].get(token) == other:
            self.next[at][token] = state
            at = self.link[at]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, str]], list[tuple[int, int, int, int]]]:
        """Places (first word, label) of phrases, and matches (template, from in template, from in text, length).

        Only stretches of words that some template holds can match, and are walked.
        """
        ids = np.fromiter((self.vocabulary.get(w, -1) for w in words), dtype=np.int64, count=len(words))
        known = np.flatnonzero(np.diff(np.r_[False, ids >= 0, False].astype(np.int8)))
        starts, stops = known[::2], known[1::2]
        places, matches = [], []
        for start, stop in zip(starts[stops - starts >= self.least].tolist(), stops[stops - starts >= self.least].tolist()):
            state = length = 0
            for at in range(start, stop):
                token = int(ids[at])
                before = state, length
                while state and token not in self.next[state]:
                    state = self.link[state]
                    length = self.long[state]
                state = self.next[state].get(token, 0)
                length = length + 1 if state else 0
                if length <= before[1]:
                    self._add(matches, *before, at - 1)
                for size, label in self.phrases[state]:
                    if size <= length:
                        places.append((at - size + 1, label))
            self._add(matches, state, length, stop - 1)
        return places, matches

    def _add(self, matches: list[tuple[int, int, int, int]], state: int, length: int, at: int) -> None:
        if length >= MATCH:
            matches += [(t, e - length + 1, at - length + 1, length) for t, e in self.ends[state] if e - length + 1 >= 0]

    def covered(self, matches: list[tuple[int, int, int, int]]) -> dict[int, float]:
        """For each template the largest share of it that a chain of matches covers.

        A chain goes forwards in template and text, with few words of the text between its matches.
        """
        out: dict[int, float] = {}
        for template in {m[0] for m in matches}:
            chains: list[tuple[int, int, int]] = []  # end in text, end in template, words covered
            for _, a, at, n in sorted((m for m in matches if m[0] == template), key=lambda m: (m[2], m[1])):
                chains = [c for c in chains if c[0] >= at - GAP]
                # A match adds the words that the chain before it doesn't cover.
                more = [c + min(n, a + n - e, at + n - t) for t, e, c in chains if t < at + n and e < a + n]
                best = max([n, *more])
                chains.append((at + n, a + n, best))
                out[template] = max(out.get(template, 0.0), best / self.sizes[template])
        return out


def build(notices=NOTICES, phrases=PHRASES) -> Automaton:
    coded = {tuple(words_of(p.encode())): label for p, label in phrases.items()}
    templates = [(label, words_of(text.encode())) for label, text in notices]
    templates += [(label, list(phrase)) for phrase, label in coded.items()]
    return Automaton(templates, coded)


FIELDS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def judge(automaton: Automaton, text: bytes | None) -> tuple:
    """The values of FIELDS for one text."""
    words = words_of(text or b"")
    places, matches = automaton.scan(words)
    shares = automaton.covered(matches)
    base = {label for _, label in places}
    found = base | {automaton.labels[t] for t, share in shares.items() if share >= SHARE}
    firsts = [at for at, _ in places]
    score = 1.0 if base else min(1.0, max(shares.values(), default=0.0))
    return (
        len(words), len(places), min(firsts, default=None), max(firsts, default=None),
        ",".join(sorted(base)), ",".join(sorted(found)), score,
    )


def scanned(docs: DataFrame, automaton: Automaton, text: str = "text") -> DataFrame:
    """Each row of ``docs`` without its text, and the columns of FIELDS, which replace any of the same name.

    ``score`` is the largest share of a notice that a chain of matches covers, one where a phrase stands whole. Null and
    empty texts have no words, no labels and score zero; rows that repeat get equal values; an empty table gives an empty
    result. Every task has the
    automaton, whose size is that of the notices, and reads whole texts, a few at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(automaton)
    names = [f.split()[0] for f in FIELDS.split(", ")]
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text and c.lower() not in names]
    (whole,) = fresh(docs, "_text_")
    rows = docs.select(*kept, F.col(text).cast("binary").alias(whole))
    schema = rows.drop(whole).schema
    for field in FIELDS.split(", "):
        schema = schema.add(*field.split())

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = shared.value
        for batch in batches:
            texts = batch.pop(whole)
            for at in range(0, max(1, len(batch)), ROWS):
                part = batch.iloc[at : at + ROWS].reset_index(drop=True)
                found = [judge(automaton, t) for t in texts.iloc[at : at + ROWS]]
                out = pd.DataFrame(found, columns=names).astype({"first_word": "Int64", "last_word": "Int64"})
                yield pd.concat([part, out], axis=1)

    return rows.mapInPandas(judged, schema)


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scanned(docs, build())
