"""License scans by template markup: wording compiled into token automata.

A template is wording with two marks, read word by word like the texts themselves:

* ``[[ ... ]]`` an optional region, which may be left out and may hold other regions;
* ``{{name 0-12}}`` a replaceable region of 0 to 12 words of any kind (a name, a year, a title).

All other words are mandatory: a place is accepted only if they stand there in order with nothing
between them but what a region allows. A template must begin and end with mandatory wording, so every
start is found by the two words that can open it (a fast substring search), and the automaton runs
only there. It is an NFA over words whose subsets are built as they are needed, shared by all texts of
a task. Of the places of one template that overlap, the leftmost stays, in its longest form.

Base phrases are plain word sequences; all their places count, overlapping ones too. Words are
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased (ASCII digits and letters, and
every other character above 0x7F).

Scanning is a projection: one pass over whole texts, no shuffle, a row's memory is its text.

Defined cases: a null text is an empty one; an empty text has no words, no places, labels '' and score
0. Repeated rows give their rows again. ``scan`` keeps every column of the table and adds one struct
column under a name that is free, so extra columns cannot clash. An empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from handoff.llm.common import ascii_words as words_of
from handoff.llm.common import fresh_name, quoted, text_bytes

#: Base phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Notices and licence texts in template markup: (label, template).
TEMPLATES = (
    ("mit", "[[the]] mit license [[mit]] [[copyright [[c]] {{holder 0-16}} [[all rights reserved]]]] "
            "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files {{the software 0-4}} to deal in the software without restriction"),
    ("mit", "released under [[the terms of]] the [[{{owner 0-3}}]] mit license"),
    ("mit", "licensed under [[the terms of]] the mit license"),
    ("mit", "distributed under [[the terms of]] the mit license"),
    ("mit", "spdx license identifier mit"),
    ("apache-2", "licensed under the apache license version 2 [[0]] [[the license [[you may not use this {{file 1-4}} "
                 "except in compliance with the license]]]]"),
    ("apache-2", "apache license [[v]] [[version]] 2 [[0]] [[january 2004]]"),
    ("apache-2", "spdx license identifier apache 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("bsd", "under [[the terms of]] the [[{{clauses 0-3}}]] bsd license"),
    ("isc", "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is "
            "hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("gpl-2", "under the [[terms of the]] gnu general public license [[gpl]] [[as published by the free software "
              "foundation]] [[either]] version 2"),
    ("gpl-3", "under the [[terms of the]] gnu general public license [[gpl]] [[as published by the free software "
              "foundation]] [[either]] version 3"),
    ("lgpl-3", "under the [[terms of the]] gnu lesser general public license [[lgpl]] [[as published by the free "
               "software foundation]] [[either]] version 3"),
    ("agpl-3", "under the [[terms of the]] gnu affero general public license [[agpl]] [[as published by the free "
               "software foundation]] [[either]] version 3"),
    ("mpl-2", "subject to the terms of the mozilla public license v [[version]] 2 0"),
    ("mpl-2", "under the [[terms of the]] mozilla public license [[v]] [[version]] 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc0", "creative commons {{title 0-4}} cc0"),
    ("cc-by-nc", "creative commons attribution [[{{mark 0-1}}]] non commercial [[{{version 0-3}} international]] license"),
    ("cc-by-nc", "creative commons attribution noncommercial [[{{version 0-3}} international]] license"),
    ("cc-by-sa", "creative commons attribution share alike [[{{version 0-3}} international]] license"),
    ("cc-by-sa", "licensed under [[a]] cc by sa"),
    ("cc-by-nc", "licensed under [[a]] cc by nc"),
)

#: Score of a text with a whole notice, and of one with a base phrase alone.
NOTICE_SCORE, PHRASE_SCORE = 1.0, 0.5

_MARK = re.compile(r"\[\[|\]\]|\{\{[^{}]*\}\}|[^\s\[\]{}]+")
_GAP = re.compile(r"\{\{(?:.*\s)?(\d+)-(\d+)\}\}")

SCAN_TYPE = ("struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base_labels:array<string>,"
             "labels:array<string>,places:array<struct<label:string,start:bigint,end:bigint,base:boolean>>>")
_PLACE = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
_SCAN = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                   ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("places", pa.list_(_PLACE))])


# ---------------------------------------------------------------- markup
def parse(template: str) -> list:
    """Nested parts: a word (bytes), an optional region (list), or a gap (least, most)."""
    stack: list[list] = [[]]
    for mark in _MARK.findall(template):
        gap = _GAP.fullmatch(mark)
        if mark == "[[":
            stack.append([])
        elif mark == "]]":
            if len(stack) == 1:
                raise ValueError(f"a region ends that never began: {template!r}")
            region = stack.pop()
            stack[-1].append(region)
        elif gap:
            least, most = int(gap[1]), int(gap[2])
            if least > most:
                raise ValueError(f"a gap of at least {least} and at most {most} words")
            stack[-1].append((least, most))
        elif mark.startswith("{{"):
            raise ValueError(f"a gap is written {{{{name least-most}}}}, not {mark!r}")
        else:
            stack[-1].extend(words_of(mark.encode()))
    if len(stack) != 1:
        raise ValueError(f"a region never ends: {template!r}")
    return stack[0]


def template_regex(template: str) -> str:
    """The template as a regular expression over texts whose every word w is written ``' w '``."""

    def part(p) -> str:
        if isinstance(p, bytes):
            return f" {p.decode()} "
        if isinstance(p, list):
            return "(?:" + "".join(map(part, p)) + ")?"
        return f"(?: [^ ]+ ){{{p[0]},{p[1]}}}"

    return "".join(map(part, parse(template)))


class Automaton:
    """Token automaton of one template; its subsets are made as they are met."""

    def __init__(self, label: str, template: str):
        self.label = label
        self._arcs: list[list[tuple[bytes | None, int]]] = [[]]  # state -> (word or None for any word, next state)
        self._free: list[list[int]] = [[]]                       # state -> states reached without a word
        parts = parse(template)
        if not parts or not isinstance(parts[-1], (bytes, list)):
            raise ValueError(f"a template ends with wording: {template!r}")
        self._end = self._build(parts, 0)
        self._subsets: dict[frozenset, int] = {}
        self._members: list[frozenset] = []
        self._steps: list[dict[bytes | None, int]] = []
        self._words = {w for arcs in self._arcs for w, _ in arcs if w is not None}
        self._accepts: list[bool] = []
        self._dead = self._subset(frozenset())
        self.start = self._subset(self._closure({0}))
        self.openings = self._openings()

    def _state(self) -> int:
        self._arcs.append([])
        self._free.append([])
        return len(self._arcs) - 1

    def _build(self, parts: list, at: int) -> int:
        for p in parts:
            if isinstance(p, bytes):
                to = self._state()
                self._arcs[at].append((p, to))
                at = to
            elif isinstance(p, list):
                to = self._state()
                self._free[self._build(p, at)].append(to)
                self._free[at].append(to)
                at = to
            else:
                least, most = p
                to = self._state()
                for i in range(most):
                    if i >= least:
                        self._free[at].append(to)
                    step = self._state()
                    self._arcs[at].append((None, step))
                    at = step
                self._free[at].append(to)
                at = to
        return at

    def _closure(self, states: set[int]) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            for s in self._free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def _subset(self, states: frozenset) -> int:
        if states not in self._subsets:
            self._subsets[states] = len(self._members)
            self._members.append(states)
            self._steps.append({})
            self._accepts.append(self._end in states)
        return self._subsets[states]

    def _openings(self) -> set[bytes]:
        """The one or two words (joined) that can open a match."""
        if self._accepts[self.start]:
            raise ValueError(f"the template {self.label} accepts no words at all")
        found = set()
        for s in self._members[self.start]:
            for word, to in self._arcs[s]:
                if word is None:
                    raise ValueError(f"the template {self.label} begins with a replaceable region")
                after = self._closure({to})
                seconds = [w for t in after for w, _ in self._arcs[t]]
                if self._end in after or None in seconds:
                    found.add(b" " + word + b" ")
                else:
                    found |= {b" " + word + b" " + w + b" " for w in seconds}
        return found

    def longest(self, words: Sequence[bytes], at: int) -> int:
        """End (exclusive) of the longest accepted run of words that starts at ``at``; -1 for none."""
        state, best = self.start, -1
        for i in range(at, len(words)):
            word = words[i] if words[i] in self._words else None
            steps = self._steps[state]
            if word not in steps:
                moved = {to for s in self._members[state] for w, to in self._arcs[s] if w is None or w == word}
                steps[word] = self._subset(self._closure(moved))
            state = steps[word]
            if state == self._dead:
                break
            if self._accepts[state]:
                best = i + 1
        return best


# ---------------------------------------------------------------- scanning
class Scanner:
    """Base phrases and compiled templates, applied to one text at a time."""

    def __init__(self, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Mapping[str, str] = PHRASES):
        self._phrases = [(b" " + b" ".join(words_of(p.encode())) + b" ", len(words_of(p.encode())), label)
                         for p, label in phrases.items()]
        self._openings: dict[bytes, list[Automaton]] = {}
        for label, template in templates:
            automaton = Automaton(label, template)
            for opening in automaton.openings:
                self._openings.setdefault(opening, []).append(automaton)

    def scan(self, text: bytes) -> dict:
        words = words_of(text)
        line = b" " + b" ".join(words) + b" "
        base = [(label, start, start + n) for phrase, n, label in self._phrases for start in _places(line, phrase)]
        starts: dict[Automaton, set[int]] = {}
        for opening, automata in self._openings.items():
            for at in _places(line, opening):
                for automaton in automata:
                    starts.setdefault(automaton, set()).add(at)
        found = set()
        for automaton, places in starts.items():
            free = 0
            for at in sorted(places):
                end = automaton.longest(words, at) if at >= free else -1
                if end > 0:
                    found.add((automaton.label, at, end))
                    free = end
        begins = [start for _, start, _ in base]
        return {
            "n_words": len(words), "n_base": len(base),
            "first_word": min(begins, default=None), "last_word": max(begins, default=None),
            "base_labels": sorted({label for label, _, _ in base}),
            "labels": sorted({label for label, _, _ in [*base, *found]}),
            "places": [{"label": lb, "start": s, "end": e, "base": b}
                       for s, e, lb, b in sorted([(s, e, lb, True) for lb, s, e in base] + [(s, e, lb, False) for lb, s, e in found])],
        }


def _places(line: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which the phrase (with its outer blanks) starts; overlapping places too."""
    found, at, word, counted = [], line.find(phrase), 0, 0
    while at >= 0:
        word += line.count(b" ", counted, at)
        counted = at
        found.append(word)
        at = line.find(phrase, at + 1)
    return found


def scan(docs: DataFrame, text_col: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES,
         phrases: Mapping[str, str] = PHRASES, into: str = "license") -> DataFrame:
    """Every row with its columns and one struct: words, base places, labels, and all places found."""
    held: list[Scanner] = []

    def run(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(Scanner(templates, phrases))
        return pa.array([held[0].scan(t) for t in text_bytes(texts)], type=_SCAN)

    return docs.withColumn(fresh_name(docs, into), F.arrow_udf(run, SCAN_TYPE)(F.col(quoted(text_col)).cast("string")))


def licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places) per row."""
    narrow = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).cast("string").alias("text"))
    s = F.col("license")
    notice = F.exists(s["places"], lambda p: ~p["base"])
    score = F.when(notice, F.lit(NOTICE_SCORE)).when(s["n_base"] > 0, F.lit(PHRASE_SCORE)).otherwise(F.lit(0.0))
    return scan(narrow).select(
        "doc_id", s["n_words"].alias("n_words"), s["n_base"].alias("n_base"), s["first_word"].alias("first_word"),
        s["last_word"].alias("last_word"), F.array_join(s["base_labels"], ",").alias("base_labels"),
        F.array_join(s["labels"], ",").alias("labels"), score.alias("score"), s["places"].alias("places"))


def oracle_sql() -> str:
    """The query in DuckDB's SQL: phrases by list positions, templates as regular expressions over words."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def starts(phrase: str) -> str:
        want = " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(phrase.split(), 1))
        return f"list_filter(range(len(w)), lambda i: {want})"

    base = ", ".join(f"{starts(p)} AS p{i}" for i, p in enumerate(PHRASES))
    every = "list_concat(" * (len(PHRASES) - 1) + "p0" + "".join(f", p{i})" for i in range(1, len(PHRASES)))
    base_labels = ", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{label}' END" for i, label in enumerate(PHRASES.values()))
    notices = ", ".join(f"CASE WHEN regexp_matches(line, '{template_regex(t)}') THEN '{label}' END" for label, t in TEMPLATES)

    def joined(labels: str) -> str:
        return f"array_to_string(list_sort(list_distinct(list_filter({labels}, lambda x: x IS NOT NULL))), ',')"

    return f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
lines AS (
  SELECT doc_id, len(w) AS n_words, CASE WHEN len(w) = 0 THEN '' ELSE ' ' || array_to_string(w, '  ') || ' ' END AS line,
    {base} FROM words),
found AS (SELECT doc_id, n_words, {every} AS every, [{base_labels}] AS bases, [{notices}] AS notices FROM lines)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(every) AS BIGINT) AS n_base,
  CAST(list_min(every) AS BIGINT) AS first_word, CAST(list_max(every) AS BIGINT) AS last_word,
  {joined('bases')} AS base_labels, {joined('list_concat(bases, notices)')} AS labels,
  CASE WHEN len(list_filter(notices, lambda x: x IS NOT NULL)) > 0 THEN {NOTICE_SCORE}
       WHEN len(every) > 0 THEN {PHRASE_SCORE} ELSE 0.0 END::DOUBLE AS score
FROM found"""
