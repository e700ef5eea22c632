"""License scans with a generalised suffix automaton over the tokens of license texts.

All phrases and templates go into one automaton. A text streams through it token by token, which gives its matching
statistics: at every token the longest run of tokens ending there that occurs in some template. From them follow

- the places of the base phrases: a phrase ends at a token if its own state is the current one or
  lies on its suffix links, and the match is as long as the phrase;
- for each template, all runs of ``SEED`` tokens or more that it shares with the text and that neither go on to the left nor to the
  right. Their shorter ones lie on the suffix links. A chain takes runs in text order where places in the template go on too, skips any
  others, and counts the tokens of a run that are new in both; a dynamic programme finds the best chain that ends with each run.
  A chain that covers at least ``COVER`` of a template is a licence span; its coverage is the score. Of chains of one template that
  overlap in the text, the one that covers most stays (then the shortest, then the first).
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import without

#: The base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Notices that authors put into files, as their licenses word them.
TEMPLATES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
                 "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "apache-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                     "with the License. You may obtain a copy of the License at",
    "apache-line": "Licensed under the Apache License, Version 2.0",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                  "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-line": "This work is licensed under the GNU General Public License, version 3",
    "mit-line": "Released under the MIT License",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                 "following conditions are met",
}
#: Tokens of a run that counts for a chain, the share of a template that a chain must cover, and the tokens of text that may lie
#: between two runs of a chain: so many, or half of the template's tokens if those are more.
SEED, COVER, GAP = 3, 0.8, 8
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str) -> list[str]:
    return _WORD.findall(text.translate(_LOWER))


class Automaton:
    """Suffix automaton of several token sequences. A state knows all places (sequence, end) where its strings end, and the first ones."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.places: list[list[tuple[int, int]]] = [[]]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, token in enumerate(sequence):
                last = self._extend(last, token)
                self.places[last].append((number, at + 1))
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[state]:
                self.places[self.link[state]] += self.places[state]
        self.ends: list[dict[int, int]] = [dict(sorted(places, reverse=True)) for places in self.places]

    def _state(self, length: int, link: int, onward: dict[int, int]) -> int:
        self.next.append(onward)
        self.link.append(link)
        self.length.append(length)
        self.places.append([])
        return len(self.link) - 1

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:
            old = self.next[last][token]
            return old if self.length[old] == self.length[last] + 1 else self._clone(last, token, old)
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and token not in self.next[last]:
            self.next[last][token] = new
            last = self.link[last]
        if last >= 0:
            old = self.next[last][token]
            self.link[new] = old if self.length[old] == self.length[last] + 1 else self._clone(last, token, old)
        return new

    def _clone(self, last: int, token: int, old: int) -> int:
        copy = self._state(self.length[last] + 1, self.link[old], dict(self.next[old]))
        self.link[old] = copy
        while last >= 0 and self.next[last].get(token) == old:
            self.next[last][token] = copy
            last = self.link[last]
        return copy

    def step(self, state: int, matched: int, token: int) -> tuple[int, int]:
        """State and match length after one more token."""
        while state and token not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        if token in self.next[state]:
            return self.next[state][token], matched + 1
        return 0, 0

    def find(self, sequence: list[int]) -> int:
        state = 0
        for token in sequence:
            state = self.next[state][token]
        return state


class Scanner:
    """Phrases and templates compiled for texts."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str], seed: int = SEED, cover: float = COVER, gap: int = GAP):
        self.seed, self.cover = seed, cover
        self.ids: dict[str, int] = {}
        phrase_words, template_words = ([words(t) for t in x] for x in (phrases, templates.values()))
        if not all(phrase_words + template_words):
            raise ValueError("a phrase or template has no words")
        coded = [[self.ids.setdefault(w, len(self.ids)) for w in ws] for ws in phrase_words + template_words]
        self.labels = list(phrases.values())
        self.templates = list(templates)
        self.sizes = [len(x) for x in coded[len(phrases):]]
        self.gaps = [max(gap, size // 2) for size in self.sizes]
        self.automaton = Automaton(coded)
        # templates that go on after each place of a state, with the token that comes there (none at an end)
        self.onward = [[(number - len(phrases), end, (*coded[number], -1)[end]) for number, end in places if number >= len(phrases)]
                       for places in self.automaton.places]
        home: dict[int, list[int]] = {}
        for number, sequence in enumerate(coded[: len(phrases)]):
            home.setdefault(self.automaton.find(sequence), []).append(number)
        self.lengths = [len(x) for x in coded[: len(phrases)]]
        # phrases that end at each state: its own and those of its suffix links
        self.phrases: list[list[int]] = [[] for _ in self.automaton.link]
        for state in sorted(range(1, len(self.automaton.link)), key=self.automaton.length.__getitem__):
            self.phrases[state] = home.get(state, []) + self.phrases[self.automaton.link[state]]

    def scan(self, text: str) -> dict:
        """Word count, phrase places (start, label) and licence spans (template, first word, end word, coverage)."""
        tokens = words(text)
        get, auto = self.ids.get, self.automaton
        coded = [get(w) for w in tokens]
        places, runs = [], []
        state = matched = 0
        for at, token in enumerate(coded):
            if matched >= self.seed:
                self._ended(at, state, matched, token, runs)
            if token is None:
                state = matched = 0
                continue
            state, matched = auto.step(state, matched, token)
            for number in self.phrases[state]:
                if matched >= self.lengths[number]:
                    places.append((at + 1 - self.lengths[number], self.labels[number]))
        if matched >= self.seed:
            self._ended(len(coded), state, matched, None, runs)
        return {"n_words": len(tokens), "places": sorted(places), "spans": self._spans(runs)}

    def _ended(self, at: int, state: int, matched: int, token: int | None, runs: list[tuple[int, int, int, int]]) -> None:
        """Adds the runs (template, end in it, end in the text, length) that do not go on with ``token``."""
        seen = set()
        while matched >= self.seed:
            for number, end, following in self.onward[state]:
                if following != token and (number, end) not in seen:
                    seen.add((number, end))
                    runs.append((number, end, at, matched))
            state = self.automaton.link[state]
            matched = self.automaton.length[state]

    def _spans(self, runs: list[tuple[int, int, int, int]]) -> list[tuple[str, int, int, float]]:
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for number, to, end, length in runs:
            by_template.setdefault(number, []).append((end, to, length))
        spans = []
        for number, own in by_template.items():
            size, taken = self.sizes[number], []
            good = [c for c in chains(own, self.gaps[number]) if c[0] >= self.cover * size]
            for covered, start, end in sorted(good, key=lambda c: (-c[0], c[2] - c[1], c[1])):
                at = bisect_left(taken, (start, end))
                if (at == len(taken) or taken[at][0] >= end) and (at == 0 or taken[at - 1][1] <= start):
                    taken.insert(at, (start, end))
                    spans.append((self.templates[number], start, end, covered / size))
        return sorted(spans, key=lambda s: (s[1], s[2], s[0]))


def chains(runs: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """For each run (end in the text, end in the template, length) the best chain that ends with it: covered tokens, first token, end token.

    A run adds the tokens beyond the last run's ends in text and template; at most ``gap`` other tokens of text may lie before
    them. Of chains that cover as much, the one that starts last.
    """
    runs = sorted(runs)
    best: list[tuple[int, int]] = []
    low = 0
    longest = max((length for _, _, length in runs), default=0)
    for end, to, length in runs:
        while runs[low][0] < end - longest - gap:
            low += 1
        found = length, end - length
        for i in range(low, len(best)):
            was_end, was_to, _ = runs[i]
            if was_end < end and was_to < to:
                fresh = min(length, end - was_end, to - was_to)
                if end - fresh - was_end <= gap:
                    found = max(found, (best[i][0] + fresh, best[i][1]))
        best.append(found)
    return [(covered, start, end) for (covered, start), (end, _, _) in zip(best, runs, strict=True)]


def scan(df: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None, text: str = "text") -> DataFrame:
    """``df`` with ``n_words``, ``places`` (start, label) and ``spans`` (template, start, end, coverage), in words from 0.

    Null counts as empty: no words, no places, no spans. Places may overlap; all are given. Repeated rows get
    equal answers; columns of these names are replaced; an empty table gives an empty table.
    """
    df = without(df, "n_words", "places", "spans")
    scanner = Scanner(PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates)
    sent = df.sparkSession.sparkContext.broadcast(scanner)

    @F.pandas_udf("n_words long, places array<struct<start:long,label:string>>, "
                  "spans array<struct<template:string,start:long,end:long,coverage:double>>")
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [sent.value.scan(t or "") for t in texts]
            yield pd.DataFrame({
                "n_words": [f["n_words"] for f in found],
                "places": [[dict(zip(("start", "label"), p, strict=True)) for p in f["places"]] for f in found],
                "spans": [[dict(zip(("template", "start", "end", "coverage"), s, strict=True)) for s in f["spans"]] for f in found]})

    columns = [F.col(f"`{c}`") for c in df.columns]
    return df.select(*columns, scanned(F.col(f"`{text}`")).alias("_found")).select(*columns, "_found.*")


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    """Base phrases and licence spans of every whole document. Score: 1 where a base phrase stands, else the best coverage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    starts = F.transform("places", lambda p: p["start"])
    base = F.transform("places", lambda p: p["label"])
    more = F.transform("spans", lambda s: s["template"])
    best = F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return scan(docs).select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"), joined(F.concat(base, more)).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(best).alias("score"))
