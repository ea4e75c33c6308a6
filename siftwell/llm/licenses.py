"""License scans: templates with optional and replaceable regions as token automata.

A template's markup is its wording with ``[[ ... ]]`` around what may be left out
(nested at will) and ``{{least..most}}`` where so many other words may stand.
``compile_templates`` makes one automaton over words of all templates: a state
stands before each word, a region's states have edges that skip it, and a set of
states is one integer, so a text is read once, word by word, and only where some
template has begun. A template is accepted where its mandatory wording stands
exactly, in order, with nothing between but its regions.

Phrases to be found literally are templates without regions.

``score`` is the largest share, over all templates, of a template's mandatory
words that the text has from the template's begin on, in steps of whole
segments (the wording between two regions): 1 where a template is accepted.

Texts are read as UTF-8 bytes, A-Z lower-cased; words are runs of digits,
letters a-z and all code points from 128 on. Whole texts are read in one Arrow
pass without a shuffle; the automaton's size is the templates'.

Edge cases: a null or empty text, or one without words, has no places, empty
labels, null word positions and score 0. Equal texts have equal results. A
template needs a mandatory word; regions before its first and after its last one
never decide and are left out of the automaton.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.llm.common import map_batches, read_table, utf8

#: label: wording that is searched for literally. Fixed values.
PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
#: (label, markup). The wording is that of the public licenses and of their usual notices. Fixed values.
TEMPLATES = [
    ("mit", "licensed under [[the terms of]] [[the]] mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so "
        "[[subject to the following conditions]] {{0..4}} the above copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies or substantial portions of the software",
    ),
    ("apache-2", "licensed under [[the terms of]] the apache license [[version]] 2 0"),
    ("apache-2", "you may not use this {{1..3}} except in compliance with the license you may obtain a copy of the license at {{0..12}} unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("gpl-3", "gnu general public license [[as published by the free software foundation [[inc]]]] [[either]] version 3"),
    ("gpl-2", "gnu general public license [[as published by the free software foundation [[inc]]]] [[either]] version 2"),
    ("lgpl", "gnu {{1..1}} general public license [[as published by the free software foundation [[inc]]]] [[either]] version 2 1"),
    ("agpl-3", "gnu affero general public license [[as published by the free software foundation [[inc]]]] [[either]] version 3"),
    ("cc-by", "creative commons attribution [[only]] 4 0 [[international]] license"),
    ("cc-by-nc", "creative commons attribution non commercial [[only]] 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial [[only]] 4 0"),
    ("cc-by-sa", "creative commons attribution share alike [[only]] 4 0"),
    ("cc-by-sa", "creative commons attribution sharealike [[only]] 4 0"),
    ("isc", "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met {{0..1}} redistributions of source code must retain the above copyright notice "
        "this list of conditions and the following disclaimer {{0..1}} redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation "
        "and or other materials provided with the distribution [[{{0..1}} neither the name of {{1..16}} may be used to endorse or promote products derived from this software without specific prior written permission]]",
    ),
    ("mpl-2", "subject to the terms of the mozilla public license [[version]] [[v]] 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"),
]
_MARK = re.compile(r"\[\[|\]\]|\{\{(\d+)\.\.(\d+)\}\}|[0-9a-z]+")
#: Bytes to what a word is made of: A-Z lower-cased, all that parts words a blank.
_BYTES = bytes(b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_PLACE = "struct<label:string,start:long,end:long>"


def words_of(text: bytes) -> list[bytes]:
    """A text's words, lower-cased in A-Z."""
    return text.translate(_BYTES).split()


@dataclass
class Template:
    """A compiled template: items (a word, or None for any) and edges that skip items, both by place."""

    label: str
    items: list[bytes | None] = field(default_factory=list)
    skips: list[tuple[int, int]] = field(default_factory=list)
    #: (place after a segment's last word, mandatory words up to there)
    segments: list[tuple[int, int]] = field(default_factory=list)

    @property
    def total(self) -> int:
        return self.segments[-1][1]


def parse(label: str, markup: str) -> Template:
    """A template from its markup, without regions outside its mandatory wording."""
    out, opened, mandatory, apart = Template(label), [], 0, True
    for m in _MARK.finditer(markup):
        token = m.group()
        if token == "[[":
            opened.append(len(out.items))
            apart = True
        elif token == "]]":
            start = opened.pop()
            if mandatory:
                out.skips.append((start, len(out.items)))
        elif m.group(1) is not None:
            least, most = int(m.group(1)), int(m.group(2))
            apart = True
            if mandatory:
                out.items += [None] * most
                # From each place that has seen enough words on, the rest of the region may be skipped.
                out.skips += [(len(out.items) - most + k, len(out.items)) for k in range(least, most)]
        elif opened:
            if mandatory:
                out.items.append(token.encode())
        else:
            mandatory += 1
            out.items.append(token.encode())
            if not apart:
                out.segments.pop()
            out.segments.append((len(out.items), mandatory))
            apart = False
    if opened or not mandatory:
        raise ValueError(f"the template {label!r} has an open region or no mandatory word")
    end = out.segments[-1][0]
    out.items, out.skips = out.items[:end], [s for s in out.skips if s[1] <= end and s[0] < end]
    return out


class Automaton:
    """All templates as one automaton over words; states are bits of an integer."""

    def __init__(self, templates: Iterable[Template]) -> None:
        self.templates = list(templates)
        self.accepts: dict[bytes, int] = {}
        self.starts: dict[bytes, int] = {}
        self.any, self.skipping, self.at = 0, 0, []
        reach: dict[int, int] = {}
        base = 0
        for t in self.templates:
            self.at.append(base)
            for i, word in enumerate(t.items):
                if word is None:
                    self.any |= 1 << (base + i)
                else:
                    self.accepts[word] = self.accepts.get(word, 0) | 1 << (base + i)
            first = t.items[0]
            self.starts[first] = self.starts.get(first, 0) | 1 << base
            for start, end in sorted(t.skips, reverse=True):  # a skip may lead to another one's begin
                reach[base + start] = reach.get(base + start, 0) | 1 << (base + end) | reach.get(base + end, 0)
            base += len(t.items) + 1
        self.reach = reach
        for state in reach:
            self.skipping |= 1 << state

    def step(self, states: int, word: bytes) -> int:
        """The states after ``word``, those included that skipping leads to."""
        states = (states & (self.accepts.get(word, 0) | self.any)) << 1
        some = states & self.skipping
        while some:
            low = some & -some
            states |= self.reach[low.bit_length() - 1]
            some ^= low
        return states

    def reached(self, words: list[bytes], begins: list[int]) -> int:
        """All states that a text reaches; ``begins`` are the places of words that some template begins with."""
        seen = states = at = 0
        n = len(words)
        for begin in begins:
            if begin < at:
                continue  # read already
            at = begin
            while at < n:
                word = words[at]
                states = self.step(states | self.starts.get(word, 0), word)
                at += 1
                if not states:
                    break
                seen |= states
            if at >= n:
                break
        return seen

    def share(self, k: int, seen: int) -> float:
        """How much of template ``k``'s mandatory wording is there."""
        t, base = self.templates[k], self.at[k]
        return max((n / t.total for place, n in t.segments if seen >> (base + place) & 1), default=0.0)

    def places(self, k: int, words: list[bytes], begins: list[int]) -> list[tuple[int, int]]:
        """(start, end) of every place where template ``k`` is accepted; the end is that of the shortest reading."""
        t, base = self.templates[k], self.at[k]
        begin, end = 1 << base, 1 << (base + len(t.items))
        own = (1 << (base + len(t.items) + 1)) - begin
        found = []
        for i in begins:
            if words[i] != t.items[0]:
                continue
            states = begin
            for j in range(i, len(words)):
                states = self.step(states, words[j]) & own
                if states & end:
                    found.append((i, j + 1))
                if not states or states & end:
                    break
        return found


def compile_templates(templates: Iterable[tuple[str, str]]) -> Automaton:
    """One automaton for (label, markup) pairs."""
    return Automaton(parse(label, markup) for label, markup in templates)


def scan(df: DataFrame, key: str, text: str, templates: list[tuple[str, str]], literal: int = 0) -> DataFrame:
    """(key, n_words, literal, places, score): where templates are accepted, in words, by start.

    ``literal`` holds the places of the first ``literal`` templates, ``places`` those of the others.
    """
    automaton = compile_templates(templates)
    kind = df.schema[key].dataType.simpleString()

    def make():
        def apply(batch):
            out = {"key": batch.column(0), "n_words": [], "literal": [], "places": [], "score": []}
            for value in utf8(batch.column(1)):
                words = words_of(value)
                begins = [i for i, w in enumerate(words) if w in automaton.starts]
                seen = automaton.reached(words, begins)
                shares = [automaton.share(k, seen) for k in range(len(automaton.templates))] if seen else [0.0]
                found = [[(t.label, *p) for k, t in enumerate(automaton.templates) if (k < literal) is own and shares[k] == 1.0 for p in automaton.places(k, words, begins)] if seen else [] for own in (True, False)]
                out["n_words"].append(len(words))
                for name, rows in zip(("literal", "places"), found, strict=True):
                    out[name].append([{"label": a, "start": s, "end": e} for a, s, e in sorted(set(rows), key=lambda x: (x[1], x[2], x[0]))])
                out["score"].append(max(shares))
            return out

        return apply

    rows = map_batches(df.select(F.col(key).alias("key"), F.col(text).alias("text")), make, f"key {kind}, n_words long, literal array<{_PLACE}>, places array<{_PLACE}>, score double")
    return rows.withColumnRenamed("key", key)


def _labels(places: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")


def op12_license_scan(spark, sf_dir: str) -> DataFrame:
    """One row per document: words, places of the literal phrases, their labels, all labels and the score."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, "doc_id", "text", [*PHRASES.items(), *TEMPLATES], len(PHRASES))
    starts = F.transform("literal", lambda p: p["start"])
    return found.select(
        "doc_id", "n_words", F.size("literal").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        _labels(F.col("literal")).alias("base_labels"), _labels(F.concat("literal", "places")).alias("labels"), "score",
    )


# -- the same in SQL: templates as regular expressions over the words, each closed by a blank ------------------------------


def _expressions(markup: str) -> list[tuple[str, int]]:
    """(expression, mandatory words) of a template up to each of its segments."""
    out, text, depth, mandatory, begun = [], "", 0, 0, False
    tokens = list(_MARK.finditer(markup))
    for i, m in enumerate(tokens):
        token = m.group()
        if token == "[[":
            depth, text = depth + 1, text + ("(?:" if begun else "")
        elif token == "]]":
            depth, text = depth - 1, text + (")?" if begun else "")
        elif m.group(1) is not None:
            text += f"(?:[^ ]+ ){{{m.group(1)},{m.group(2)}}}" if begun else ""
        elif depth:
            text += token + " " if begun else ""
        else:
            begun, mandatory, text = True, mandatory + 1, text + token + " "
            following = tokens[i + 1].group() if i + 1 < len(tokens) else "[["
            if following == "[[" or following.startswith("{{"):
                out.append((text, mandatory))
    return out


def _sql() -> str:
    shares, labels = [], []
    for label, markup in [*PHRASES.items(), *TEMPLATES]:
        steps = _expressions(markup)
        matches = lambda e: f"regexp_matches(s, '(^| ){e}')"
        shares.append("CASE " + " ".join(f"WHEN {matches(e)} THEN {n} / {steps[-1][1]}::DOUBLE" for e, n in reversed(steps)) + " ELSE 0 END")
        labels.append(f"CASE WHEN {matches(steps[-1][0])} THEN '{label}' END")
    at = []
    for label, phrase in PHRASES.items():
        parts = phrase.split()
        same = " AND ".join(f"w[i + {k}] = '{p}'" for k, p in enumerate(parts))
        at.append(f"list_transform(list_filter(range(1, len(w) + 1), lambda i: {same}), lambda i: {{'i': i - 1, 'label': '{label}'}})")
    distinct = lambda xs: f"array_to_string(list_sort(list_distinct({xs})), ',')"
    return rf"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
u AS (SELECT doc_id, w, array_to_string(w, ' ') || ' ' AS s, list_concat({', '.join(at)}) AS base FROM t)
SELECT doc_id, len(w) AS n_words, len(base) AS n_base, list_min(list_transform(base, lambda x: x.i)) AS first_word, list_max(list_transform(base, lambda x: x.i)) AS last_word,
  {distinct("list_transform(base, lambda x: x.label)")} AS base_labels,
  {distinct(f"list_filter([{', '.join(labels)}], lambda x: x IS NOT NULL)")} AS labels,
  greatest({', '.join(shares)})::DOUBLE AS score
FROM u
"""


OP12_SQL = _sql()
