import re
from collections import Counter
from fractions import Fraction
from math import comb, exp

import cases
import pytest

from storelens.llm import rules


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    hit = {k + j for k in range(len(words) - 4) if seen[tuple(words[k : k + 5])] > 1 for j in range(5)}
    earlier, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in earlier
            earlier.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


@pytest.mark.parametrize("text", [*cases.TEXTS, "a b c d e a b c d e", "a a a a a a a", "\n\n \nx\nx\n x\nx", "a\x0bb\x1cc"])
def test_counts_like_their_definitions(text):
    assert rules.counts_of(text)[:5] == plain_counts(text)


def test_bound_is_the_exact_binomial():
    for k, n, p in ((0, 10, 0.1), (3, 40, 0.2), (7, 60, 0.05), (60, 60, 0.5)):
        q = Fraction(p).limit_denominator(1000)
        want = sum(comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(k + 1))
        assert abs(exp(rules.log_binomial_tail(k, n, float(q))) - float(want)) < 1e-9
    assert not rules.holds(0, 0, 0.01, 0.05) and not rules.holds(0, 298, 0.01, 0.05) and rules.holds(0, 299, 0.01, 0.05)


def labelled(spark, good, bad):
    clean = [(i, cases.prose(40, i), "en") for i in range(good)]
    junk = [(good + i, " ".join(w + "###" for w in cases.prose(40, 7 * i).split()), "en") for i in range(bad)]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string")
    return docs, spark.createDataFrame([(i, int(i < good)) for i in range(good + bad)], "doc_id long, quality int")


def test_proven_cutoffs_reject_junk_and_keep_good(spark):
    docs, labels = labelled(spark, 900, 60)
    judged = rules.judge(docs, labels)
    got = Counter((r.doc_id < 900, r.kept) for r in judged.select("_row.doc_id", "kept").collect())
    assert got[(False, True)] == 0
    assert got[(True, False)] <= rules.RISK * 900


def test_too_few_labels_leave_the_base_rule(spark):
    docs, labels = labelled(spark, 60, 20)
    assert all(r.kept is not r.base_failed and not r.failed_rules for r in rules.judge(docs, labels).collect())


def test_mildest_failure_stops_the_sequence(spark):
    rows = [("en", *([3.0] * (i < 30) + [0.0] * (i >= 30)), *[0.0] * (len(rules.RULES) - 1)) for i in range(1000)]
    frame = spark.createDataFrame(rows, "stratum string, " + ", ".join(f"{n} double" for n, _, _ in rules.RULES))
    found = {r.rule: r.cutoff for r in rules.cutoffs(frame, 1).collect()}
    assert "symbols_per_word" not in found  # three per cent above the mildest cutoff already
    assert found["repeated_words"] == 0.1


def test_awkward_documents(spark):
    judged = rules.judge(cases.documents(spark), cases.labels(spark))
    got = Counter(tuple(r) for r in judged.select("_row.doc_id", *rules.COUNTS[:5], "base_failed", "kept").collect())
    want = Counter()
    for r in cases.rows():
        c = plain_counts(r[1])
        failed = c[0] < 10 or 100 * c[4] > 20 * c[0]
        want[(r[0], *c, failed, not failed)] += 1
    assert got == want
    assert rules.judge(cases.empty(spark), cases.labels(spark)).count() == 0
    good = rules.good_documents(cases.documents(spark), cases.labels(spark).limit(0))
    assert good.schema == cases.documents(spark).schema
    assert good.count() == sum(n for k, n in want.items() if k[-1])
