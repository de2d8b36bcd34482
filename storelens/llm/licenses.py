"""Licence texts found by templates: optional and replaceable regions compiled to automata over words."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from storelens.llm.tables import each_slice, packed
from storelens.llm.words import WORD, lowered

#: Phrases whose consecutive words count as places of a label.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

#: Templates of licence notices. [[...]] may be missing, {{n}} stands for up to n words of any kind, (a|b) for either wording.
#: The rest is mandatory and has to match word by word.
TEMPLATES = [
    ("mit", "[[this (software|project|code|work|document|file) is]] (released|licensed|available|distributed|provided) under the [[terms of the]] mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache", "[[this (software|project|code|work|document|file) is]] (released|licensed|available|distributed|provided) under the [[terms of the]] apache license [[version]] 2 0 [[the license]]"),
    ("gpl", "[[this (program|software|project|code|work|document|file) is]] (released|licensed|available|distributed|provided) under the [[terms of the]] gnu general public license [[as published by the free software foundation]] [[(version|v) (2|3)]] [[or [[at your option]] any later version]]"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("cc-by", "[[this (work|text|article|document|content) is]] (released|licensed|available|distributed|provided) under [[a|the]] cc by (1|2|3|4) 0"),
    ("cc-by", "[[this (work|text|article|document|content) is]] (released|licensed|available|distributed|provided) under [[a|the]] creative commons attribution (1|2|3|4) 0 [[international]] license"),
    ("cc-by-nc", "[[this (work|text|article|document|content) is]] (released|licensed|available|distributed|provided) under [[a|the]] cc by nc [[(sa|nd)]] (1|2|3|4) 0"),
    ("cc-by-sa", "[[this (work|text|article|document|content) is]] (released|licensed|available|distributed|provided) under [[a|the]] cc by sa (1|2|3|4) 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("copyright", "copyright [[c]] {{6}} all rights reserved"),
]

_TOKEN = re.compile(r"\[\[|\]\]|\{\{\d+\}\}|[()|]|[^\s\[\](){}|]+")


@dataclass
class Automaton:
    """States are numbers; ``words`` leads on over one word, ``free`` without one. ``any_`` accepts every word. The first state is 0."""

    label: str
    words: list[dict[bytes, set[int]]] = field(default_factory=list)
    any_: list[set[int]] = field(default_factory=list)
    free: list[set[int]] = field(default_factory=list)
    end: int = 0

    def state(self) -> int:
        for x, kind in ((self.words, dict), (self.any_, set), (self.free, set)):
            x.append(kind())
        return len(self.words) - 1

    def closure(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in self.free[todo.pop()] - seen:
                seen.add(t)
                todo.append(t)
        return frozenset(seen)

    def step(self, states: frozenset[int], word: bytes) -> frozenset[int]:
        out: set[int] = set()
        for s in states:
            out |= self.words[s].get(word, set()) | self.any_[s]
        return self.closure(out)

    def first_words(self) -> set[bytes]:
        return {w for s in self.closure({0}) for w in self.words[s]}

    def longest(self, words: list[bytes], at: int) -> int:
        """Where the longest match from word ``at`` on ends, -1 if there is none."""
        states, end = self.closure({0}), -1
        for k in range(at, len(words)):
            states = self.step(states, words[k])
            if not states:
                break
            if self.end in states:
                end = k + 1
        return end


def compile_template(label: str, template: str) -> Automaton:
    """Thompson's construction over the words of a template. A template has to begin with a word, not with a replaceable region."""
    tokens, made = _TOKEN.findall(template), Automaton(label)
    at = 0

    def sequence(start: int, stop: set[str]) -> int:
        nonlocal at
        ends, now = [], start
        while at < len(tokens) and tokens[at] not in stop:
            token = tokens[at]
            at += 1
            if token in ("[[", "("):
                after = sequence(now, {"]]"} if token == "[[" else {")"})
                at += 1
                if token == "[[":
                    made.free[now].add(after)
                now = after
            elif token == "|":
                ends.append(now)
                now = start
            elif token.startswith("{{"):
                last = made.state()
                for _ in range(int(token[2:-2])):
                    new = made.state()
                    made.free[now].add(last)
                    made.any_[now].add(new)
                    now = new
                made.free[now].add(last)
                now = last
            else:
                new = made.state()
                made.words[now].setdefault(token.encode(), set()).add(new)
                now = new
        out = made.state()
        for e in [*ends, now]:
            made.free[e].add(out)
        return out

    made.end = sequence(made.state(), set())
    return made


class Scanner:
    """All phrases and templates together; words that can begin one are looked up first."""

    def __init__(self, phrases=PHRASES, templates=TEMPLATES):
        self.phrases = [(tuple(w.encode() for w in p.split()), label) for p, label in phrases]
        self.automata = [compile_template(label, t) for label, t in templates]
        self.begins: dict[bytes, list[Automaton]] = {}
        for a in self.automata:
            for w in a.first_words():
                self.begins.setdefault(w, []).append(a)
        # A text without one of these words in it has no match: of each phrase the last word, of each template a mandatory one.
        self.needed = sorted({p[-1] for p, _ in self.phrases} | {self._mandatory(t) for _, t in templates})

    @staticmethod
    def _mandatory(template: str) -> bytes:
        """The longest word outside optional and alternative regions."""
        depth, words = 0, []
        for t in _TOKEN.findall(template):
            depth += (t in ("[[", "(")) - (t in ("]]", ")"))
            if not depth and re.fullmatch(r"[0-9a-z]+", t):
                words.append(t)
        return max(words, key=len).encode()

    def scan(self, text: bytes) -> tuple:
        words = WORD.findall(text)
        if not any(w in text for w in self.needed):
            return len(words), 0, None, None, "", "", 0.0, 0
        places, labels = [], set()
        seen = set(words)
        for phrase, label in self.phrases:
            if seen.issuperset(phrase):
                n, at = len(phrase), [i for i, w in enumerate(words) if w == phrase[0]]
                found = [i for i in at if tuple(words[i : i + n]) == phrase]
                places += found
                labels |= {label} if found else set()
        accepted, covered = set(), 0
        if not seen.isdisjoint(self.begins):
            for i, w in enumerate(words):
                for a in self.begins.get(w, ()):
                    end = a.longest(words, i)
                    if end > 0:
                        accepted.add(a.label)
                        covered = max(covered, end - i)
        both = labels | accepted
        score = 1.0 if accepted else 0.5 if labels else 0.0
        return (len(words), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(labels)), ",".join(sorted(both)), score, covered)


FIELDS = [
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()), T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("matched_words", T.LongType()),
]
RESULT = [f.name for f in FIELDS]


def scan_licenses(docs: DataFrame, text: str = "text", phrases=PHRASES, templates=TEMPLATES, carry: tuple[str, ...] = ("_text", "_row")) -> DataFrame:
    """Every row of ``docs`` as ``carry`` (see ``tables.packed``) with RESULT.

    n_base counts all places of all phrases, first_word and last_word are their least and greatest start;
    base_labels are the phrases' labels, labels those and the labels of accepted templates. score is 1 where a
    template's mandatory wording matches, 0.5 where only a phrase stands, else 0; matched_words is the length of the longest
    accepted notice. Null and empty texts have no words, no places (null) and score 0.
    Repeated rows are scanned one by one. Whole texts are scanned.
    """
    known: list[Scanner] = []

    def compute(part: pa.RecordBatch) -> list:
        if not known:
            known.append(Scanner(phrases, templates))
        return [list(c) for c in zip(*(known[0].scan(lowered(t)) for t in part.column("_text").to_pylist()))]

    return each_slice(packed(docs, text), compute, FIELDS, list(carry))
