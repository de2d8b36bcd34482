import re
from collections import Counter

import cases
import pytest

from storelens.llm import licenses
from storelens.llm.sql import _pattern
from storelens.llm.words import lowered

SCANNER = licenses.Scanner()


@pytest.mark.parametrize("text, labels, base", [
    ("This work is licensed under the GNU General Public License, version 3.", "gpl", "gpl"),
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc", "cc-by"),
    ("Licensed under the Apache License, Version 2.0.", "apache", "apache"),
    ("Released under the terms of the MIT-License", "mit", "mit"),
    ("the mit license", "mit", "mit"),
    ("released beneath the mit license", "mit", "mit"),
    ("Copyright (c) 2020 A. N. Other and friends. All rights reserved.", "copyright", ""),
    ("Copyright one two three four five six seven all rights reserved", "", ""),
    ("licensed under a Creative Commons Attribution 4.0 International License", "cc-by", ""),
    ("licensed under Creative Commons Attribution-NonCommercial 4.0", "", ""),
    ("gnu general public", "", ""), ("", "", ""), (None, "", ""),
])
def test_labels(text, labels, base):
    got = SCANNER.scan(lowered(text))
    assert (got[5], got[4]) == (labels, base)


def test_places_and_score():
    assert SCANNER.scan(lowered("MIT license. x mit License; gnu general public license"))[:7] == (9, 3, 0, 5, "gpl,mit", "gpl,mit", 0.5)
    assert SCANNER.scan(lowered("so released under the mit license now"))[1:] == (1, 4, 4, "mit", "mit", 1.0, 5)
    assert SCANNER.scan(lowered("nothing"))[1:] == (0, None, None, "", "", 0.0, 0)


@pytest.mark.parametrize("label, template", licenses.TEMPLATES)
def test_automata_accept_what_the_regular_expression_accepts(label, template):
    import random

    r = random.Random(template)
    automaton, pattern = licenses.compile_template(label, template), re.compile(_pattern(template))
    vocabulary = re.findall(r"[0-9a-z]+", template) + ["x"]
    sound = [w for w in re.findall(r"[0-9a-z]+", template)]
    for _ in range(150):
        words = [w for w in sound if r.random() > 0.08]
        if r.random() < 0.5 and words:
            words[r.randrange(len(words))] = r.choice(vocabulary)
        words = ["x"] * r.randint(0, 2) + words
        raw = [w.encode() for w in words]
        assert any(automaton.longest(raw, i) > 0 for i in range(len(raw))) == bool(pattern.search(" " + " ".join(words) + " "))


def test_awkward_documents(spark):
    docs = cases.documents(spark)
    found = licenses.scan_licenses(docs)
    assert found.count() == docs.count()
    got = Counter((r.doc_id, r.n_words, r.labels) for r in found.select("_row.doc_id", "n_words", "labels").collect())
    assert got == Counter((r[0], len(re.findall(rb"[0-9a-z\x80-\xff]+", lowered(r[1]))), "mit" if r[0] == 12 else "") for r in cases.rows())
    assert licenses.scan_licenses(cases.empty(spark)).count() == 0
