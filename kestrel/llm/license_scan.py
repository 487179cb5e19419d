"""License scans (13): template markup compiled to token automata.

A template is wording with marked regions:

* ``<<beginOptional>> ... <<endOptional>>``: wording that may be left out; regions nest;
* ``<<var;words="2..8">>``: replaceable by any 2 to 8 words;
* ``<<var;match="a b|c">>``: replaceable by one of the listed wordings.

All other wording is mandatory and must stand word for word. Every template
becomes a nondeterministic automaton over words, all of them together one
deterministic automaton (subset construction over the words that occur in
templates, every other word being one class). The scan of a batch of texts
starts it at each word that can begin a template and steps all these starts at
once through the transition table, so its cost is a few array operations per
word and doesn't depend on the number of templates. Words are looked up by
hash; what is accepted is compared again word by word with the template.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MARK = re.compile(r'<<(beginOptional|endOptional|var;(words|match)="([^"]*)")>>')


class Template(NamedTuple):
    name: str
    label: str
    markup: str
    base: bool = False      # a plain phrase whose places are counted on their own


# The wording of short notices and of the opening clauses of license texts.
TEMPLATES = (
    Template("mit-phrase", "mit", "mit license", True),
    Template("apache-phrase", "apache", "apache license", True),
    Template("gpl-phrase", "gpl", "general public license", True),
    Template("mit-notice", "mit", '<<var;match="licensed|released|distributed|available">> under the '
             '<<beginOptional>>terms of the<<endOptional>> <<beginOptional>>expat<<endOptional>> mit license'),
    Template("mit-text", "mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
             "documentation files <<beginOptional>>the software<<endOptional>> to deal in the software without restriction"),
    Template("apache-2.0-notice", "apache-2.0", "apache license <<beginOptional>>version<<endOptional>> 2 0"),
    Template("apache-2.0-short", "apache-2.0", '<<var;match="licensed|released">> under <<beginOptional>>the<<endOptional>> apache 2 0'),
    Template("gpl-3.0-notice", "gpl-3.0", "general public license <<beginOptional>>as published by the free software foundation "
             "<<beginOptional>>either<<endOptional>><<endOptional>> <<beginOptional>>gpl<<endOptional>> version 3"),
    Template("gpl-2.0-notice", "gpl-2.0", "general public license <<beginOptional>>as published by the free software foundation "
             "<<beginOptional>>either<<endOptional>><<endOptional>> <<beginOptional>>gpl<<endOptional>> version 2"),
    Template("lgpl-notice", "lgpl", 'gnu <<var;match="lesser|library">> general public license'),
    Template("agpl-notice", "agpl", "gnu affero general public license"),
    Template("cc-by-notice", "cc-by", '<<var;match="cc by|creative commons attribution">> <<var;match="1 0|2 0|2 5|3 0|4 0">>'),
    Template("cc-by-sa-notice", "cc-by-sa", '<<var;match="cc by sa|creative commons attribution sharealike|creative commons attribution share alike">> '
             '<<var;match="1 0|2 0|2 5|3 0|4 0">>'),
    Template("cc-by-nc-notice", "cc-by-nc", '<<var;match="cc by nc|creative commons attribution noncommercial|creative commons attribution non commercial">> '
             '<<beginOptional>><<var;match="sa|nd|sharealike|noderivatives">><<endOptional>> <<var;match="1 0|2 0|2 5|3 0|4 0">>'),
    Template("cc0-notice", "cc0", '<<var;match="cc0|creative commons zero">> <<beginOptional>>v<<endOptional>> 1 0'),
    Template("bsd-text", "bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("bsd-notice", "bsd", 'bsd <<var;match="2|3|4|new|modified|simplified|two|three">> <<beginOptional>>clause<<endOptional>> license'),
    Template("isc-text", "isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("mpl-2.0-notice", "mpl-2.0", "mozilla public license <<beginOptional>>v<<endOptional>> <<beginOptional>>version<<endOptional>> 2 0"),
    Template("unlicense-text", "unlicense", "this is free and unencumbered software released into the public domain"),
    Template("reserved-notice", "all-rights-reserved", 'copyright <<beginOptional>>c<<endOptional>> <<var;words="1..8">> all rights reserved'),
)

MATCHES = "array<struct<template:string,label:string,base:boolean,start:long,end:long,mandatory:int>>"
SCHEMA = f"id long, n_words long, matches {MATCHES}"


def tokens(text: str) -> list[str]:
    """Words of a text as the scan sees them."""
    return re.findall(WORD, re.sub("[A-Z]+", lambda m: m[0].lower(), text))


def parse(markup: str) -> list:
    """Markup as a sequence of words, ``("optional", sequence)``, ``("any", low, high)`` and ``("one", [words, ...])``."""
    stack: list[list] = [[]]
    at = 0
    for m in [*MARK.finditer(markup), None]:
        plain = markup[at: m.start() if m else len(markup)]
        if "<<" in plain or ">>" in plain:
            raise ValueError(f"unknown mark in {plain!r}")
        stack[-1] += tokens(plain)
        if m is None:
            break
        at = m.end()
        if m[1] == "beginOptional":
            stack.append([])
        elif m[1] == "endOptional":
            if len(stack) == 1:
                raise ValueError("endOptional without beginOptional")
            inner = stack.pop()
            stack[-1].append(("optional", inner))
        elif m[2] == "words":
            low, high = (int(x) for x in m[3].split(".."))
            if not 0 <= low <= high:
                raise ValueError(f"bad bounds {m[3]!r}")
            stack[-1].append(("any", low, high))
        else:
            stack[-1].append(("one", [tokens(x) for x in m[3].split("|")]))
    if len(stack) > 1:
        raise ValueError("beginOptional without endOptional")
    if not mandatory_words(stack[0]):
        raise ValueError("a template needs mandatory wording")
    return stack[0]


def mandatory_words(sequence: list) -> int:
    """Number of words that stand in every accepted text (the least choice of a ``match``)."""
    return sum(1 if isinstance(x, str) else min(map(len, x[1])) if x[0] == "one" else 0 for x in sequence)


class Nfa:
    """Thompson-style automaton: ``edges[state]`` lists (word or None for any word, next), ``skips`` the empty moves."""

    def __init__(self) -> None:
        self.edges: list[list[tuple[str | None, int]]] = [[]]
        self.skips: list[list[int]] = [[]]
        self.accepts: dict[int, int] = {}

    def state(self) -> int:
        self.edges.append([])
        self.skips.append([])
        return len(self.edges) - 1

    def step(self, a: int, word: str | None) -> int:
        b = self.state()
        self.edges[a].append((word, b))
        return b

    def add(self, sequence: list, at: int) -> int:
        for x in sequence:
            if isinstance(x, str):
                at = self.step(at, x)
            elif x[0] == "optional":
                end = self.add(x[1], at)
                after = self.state()
                self.skips[at].append(after)
                self.skips[end].append(after)
                at = after
            elif x[0] == "any":
                after = self.state()
                for i in range(x[2] + 1):
                    if i >= x[1]:
                        self.skips[at].append(after)
                    if i < x[2]:
                        at = self.step(at, None)
                at = after
            else:
                after = self.state()
                for words in x[1]:
                    self.skips[self.add(words, at)].append(after)
                at = after
        return at

    def closure(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for b in self.skips[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        return frozenset(seen)


class Scanner:
    """One deterministic automaton of all templates: ``table[state, word code]``, code 0 for every other word, state 0 dead, 1 the start."""

    def __init__(self, templates: tuple[Template, ...]):
        self.templates = templates
        parsed = [parse(t.markup) for t in templates]
        self.mandatory = [mandatory_words(s) for s in parsed]
        nfa = Nfa()
        for k, sequence in enumerate(parsed):
            begin = nfa.state()
            nfa.skips[0].append(begin)
            nfa.accepts[nfa.add(sequence, begin)] = k
        words = sorted({w for out in nfa.edges for w, _ in out if w is not None})
        self.codes = {w: i + 1 for i, w in enumerate(words)}
        sets = {frozenset(): 0, nfa.closure({0}): 1}
        order = list(sets)
        rows = []
        for subset in order:
            moves: dict[int, set[int]] = {}
            free = {b for a in subset for w, b in nfa.edges[a] if w is None}
            for a in subset:
                for w, b in nfa.edges[a]:
                    if w is not None:
                        moves.setdefault(self.codes[w], set(free)).add(b)
            row = np.zeros(len(words) + 1, dtype=np.int32)
            for code in range(len(words) + 1):
                target = nfa.closure(moves.get(code, free))
                if target not in sets:
                    sets[target] = len(order)
                    order.append(target)
                row[code] = sets[target]
            rows.append(row)
        self.table = np.array(rows)
        self.accepted = [sorted({nfa.accepts[a] for a in subset if a in nfa.accepts}) for subset in order]
        if self.accepted[1]:
            raise ValueError("a template accepts no words at all")
        self.accepting = np.array([bool(x) for x in self.accepted])
        raw = [w.encode() for w in words]
        ends = np.cumsum([len(w) for w in raw])
        hashes = tv.span_hashes(np.frombuffer(b"".join(raw), dtype=np.uint8), ends - [len(w) for w in raw], ends)
        self.by_hash = np.argsort(hashes)
        self.hashes = hashes[self.by_hash]
        self.words = words

    def encode(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.by_hash[at] + 1, 0)

    def scan(self, codes: np.ndarray, stop: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, first word, word after the last) of all matches, the longest per template and first word.

        ``stop[i]`` is the end of the text that word ``i`` belongs to.
        """
        start = np.flatnonzero(self.table[1, codes])
        state, n = np.ones(len(start), dtype=np.int32), 0
        longest: dict[tuple[int, int], int] = {}
        while len(start):
            inside = start + n < stop[start]
            start, state = start[inside], state[inside]
            state = self.table[state, codes[start + n]]
            live = state != 0
            start, state, n = start[live], state[live], n + 1
            for i in np.flatnonzero(self.accepting[state]):
                for k in self.accepted[state[i]]:
                    longest[k, int(start[i])] = int(start[i]) + n
        return [(k, a, b) for (k, a), b in longest.items()]


_scanners: dict[tuple[Template, ...], Scanner] = {}


def scanner(templates: tuple[Template, ...]) -> Scanner:
    if templates not in _scanners:
        _scanners[templates] = Scanner(templates)
    return _scanners[templates]


_WORD_BYTE = np.zeros(256, dtype=bool)
_WORD_BYTE[ord("0"): ord("9") + 1] = True
_WORD_BYTE[ord("a"): ord("z") + 1] = True
_WORD_BYTE[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32


def _batches(batches: Iterator[pa.RecordBatch], templates: tuple[Template, ...]) -> Iterator[pa.RecordBatch]:
    auto = scanner(templates)
    names = [np.array(x, dtype=object) for x in zip(*[(t.name, t.label, t.base, m) for t, m in zip(auto.templates, auto.mandatory)])]
    for batch in batches:
        ids = batch.column(0)
        for a, b, raw, offsets in tv.chunks(batch.column(1)):
            data = _LOWER[raw]
            doc, starts, ends = tv.spans(_WORD_BYTE[data], offsets)
            codes = auto.encode(tv.span_hashes(data, starts, ends))
            known = np.flatnonzero(codes)
            counts = np.bincount(doc, minlength=b - a).astype(np.int64)
            base = np.concatenate(([0], np.cumsum(counts)))
            found = auto.scan(codes, base[doc + 1])
            for i in {i for _, x, y in found for i in range(x, y)}.intersection(known.tolist()):
                if data[starts[i]: ends[i]].tobytes() != auto.words[codes[i] - 1].encode():
                    codes[i] = 0
                    found = None
            if found is None:       # two words of one hash
                found = auto.scan(codes, base[doc + 1])
            rows = np.array(sorted((doc[x], x - base[doc[x]], y - base[doc[x]], k) for k, x, y in found), dtype=np.int64).reshape(-1, 4)
            kind = rows[:, 3]
            items = pa.StructArray.from_arrays(
                [pa.array(names[0][kind], pa.string()), pa.array(names[1][kind], pa.string()), pa.array(names[2][kind], pa.bool_()),
                 pa.array(rows[:, 1], pa.int64()), pa.array(rows[:, 2], pa.int64()), pa.array(names[3][kind], pa.int32())],
                ["template", "label", "base", "start", "end", "mandatory"])
            per = pa.array(np.searchsorted(rows[:, 0], np.arange(b - a + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(per, items)],
                                             ["id", "n_words", "matches"])


def license_matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per document: ``id, n_words, matches`` with the spans of words that a template accepts.

    A match names its template, label, ``base`` flag, first word, the word after its
    last (words counted from 0) and the template's mandatory words; per
    template and first word the longest span counts, and matches are sorted by span and template.

    Edge cases: null, empty and wordless texts have no words and an empty list; null and
    repeated ids keep their rows; texts are scanned whole, whatever their
    length; overlapping matches are all listed; only A-Z is lower-cased; other columns
    aren't read; an empty table gives none. Faulty markup raises ``ValueError`` when the plan is built.
    """
    scanner(templates)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda it: _batches(it, templates), SCHEMA)


def summary(matches: DataFrame) -> DataFrame:
    """Adds the labels and a score to the rows of ``license_matches``.

    ``n_base, first_word, last_word`` count the places of base phrases and give
    their smallest and largest first word (null without any); ``base_labels``
    and ``labels`` are distinct, sorted and comma-joined; ``score`` is ``1 - 2**-m``
    with ``m`` the most mandatory words of an accepted template (0 without any).
    """
    m = F.col("matches")
    base = F.filter(m, lambda x: x["base"])
    joined = lambda xs: F.array_join(F.array_sort(F.array_distinct(F.transform(xs, lambda x: x["label"]))), ",")
    starts = F.transform(base, lambda x: x["start"])
    most = F.coalesce(F.array_max(F.transform(m, lambda x: x["mandatory"])), F.lit(0))
    return matches.select("*", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                          joined(base).alias("base_labels"), joined(m).alias("labels"), (F.lit(1.0) - F.pow(F.lit(2.0), -most)).alias("score"))


def as_regex(markup: str) -> str:
    """The template as a regular expression over words that each have one blank after them; for checks by another way."""
    def of(sequence: list) -> str:
        out = ""
        for x in sequence:
            if isinstance(x, str):
                out += x + " "
            elif x[0] == "optional":
                out += f"(?:{of(x[1])})?"
            elif x[0] == "any":
                out += f"(?:[^ ]+ ){{{x[1]},{x[2]}}}"
            else:
                out += "(?:" + "|".join(of(words) for words in x[1]) + ")"
        return out

    return of(parse(markup))
