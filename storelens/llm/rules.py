"""Quality rules whose cutoffs carry a proven limit on false rejection in every stratum."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm.tables import each_slice, packed, stored, unpacked

#: Fixed values of the base rule: white space, symbols, window of repeated words, fewest words, largest share of repeated words in per cent.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20

#: Rules as (name, SQL over the counts, candidate cutoffs from the mildest to the strictest). A document is rejected by a
#: rule if its figure is above the cutoff. Candidates are fixed before any label is seen.
RULES = [
    ("symbols_per_word", "n_symbols / greatest(n_words, 1)", [2.0, 1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.075, 0.05]),
    ("repeated_words", "n_repeat_words / greatest(n_words, 1)", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1]),
    ("repeated_lines", "n_dup_lines / greatest(n_lines, 1)", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2]),
    ("upper_case", "n_upper / greatest(n_letters, 1)", [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2]),
    ("one_word_share", "n_top_word / greatest(n_words, 1)", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3]),
    ("long_words", "word_chars / greatest(n_words, 1)", [200.0, 100.0, 50.0, 30.0, 20.0, 15.0]),
]
#: Share of good documents that all rules together may reject in a stratum, and the chance that this fails anywhere.
RISK = 0.05
FAILURE = 0.05
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_top_word"]
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_LETTER = re.compile(r"[^\W\d_]")


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words inside a window of ``window`` words that stands twice or more in the text, the first time included."""
    grams = list(zip(*(words[k:] for k in range(window))))
    if len(set(grams)) == len(grams):
        return 0
    places: dict[tuple, int] = {}
    for g in grams:
        places[g] = places.get(g, 0) + 1
    hit = np.array([places[g] > 1 for g in grams], bool)
    edge = np.zeros(len(words) + 1, np.int64)
    edge[: len(hit)] += hit
    edge[window : window + len(hit)] -= hit
    return int((np.cumsum(edge[:-1]) > 0).sum())


def counts_of(text: str | None) -> tuple[int, ...]:
    """COUNTS of one text; null counts as empty."""
    text = text or ""
    words = WORD.findall(text)
    # A line with a word is told apart by its whole content; other white space is part of a line.
    lines = [x for x in text.split("\n") if x.strip("\x20\x09\x0a\x0b\x0c\x0d")]
    tally: dict[str, int] = {}
    for w in words:
        tally[w] = tally.get(w, 0) + 1
    upper = len(_UPPER.findall(text))
    letters = len(_LETTER.findall(text)) if upper else 1
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words),
            len(lines), upper, letters, max(tally.values(), default=0))


def measured(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("_text", "_row")) -> DataFrame:
    """Every row of ``docs`` as ``carry`` (see ``tables.packed``) with COUNTS and base_failed."""

    def compute(part: pa.RecordBatch) -> list:
        return [np.array(c, np.int64) for c in zip(*map(counts_of, part.column("_text").to_pylist()))]

    rows = each_slice(packed(docs, text), compute, [T.StructField(c, T.LongType()) for c in COUNTS], list(dict.fromkeys([*carry, "_row"])))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def log_binomial_tail(k: int, n: int, p: float) -> float:
    """log P(X <= k) for X of a binomial distribution, summed exactly from its terms."""
    if p <= 0 or k >= n:
        return 0.0
    if p >= 1:
        return -np.inf
    i = np.arange(1, k + 1, dtype=float)
    terms = n * np.log1p(-p) + np.concatenate([[0.0], np.cumsum(np.log((n - i + 1) / i) + np.log(p) - np.log1p(-p))])
    top = terms.max()
    return float(top + np.log(np.exp(terms - top).sum()))


def holds(rejected: int, n: int, risk: float, chance: float) -> bool:
    """Whether ``rejected`` of ``n`` good documents prove a rate of at most ``risk``, wrong with at most ``chance``:
    the exact upper (Clopper-Pearson) bound of the rate lies at or under ``risk``."""
    return n > 0 and log_binomial_tail(rejected, n, risk) <= np.log(chance)


def cutoffs(labelled: DataFrame, strata: int, risk: float = RISK, failure: float = FAILURE) -> DataFrame:
    """(stratum, rule, cutoff) from good documents (stratum, base_failed, figures); no row where nothing can be proven.

    Each rule gets an equal part of the risk, so that the rules together keep it. In a stratum a rule's
    candidates are tested from the mildest on and the last that holds before the first that does not is
    taken: a fixed sequence, which costs no correction. Strata times rules is corrected by Bonferroni.
    """
    names = [r for r, _, _ in RULES]
    steps = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(i).alias("step"), F.lit(float(c)).alias("cutoff"), (F.col(r) > c).cast("long").alias("hit")) for r, _, cs in RULES for i, c in enumerate(cs)])
    counted = labelled.select("stratum", F.explode(steps).alias("s")).groupBy("stratum", "s.rule", "s.step", "s.cutoff").agg(F.count("*").alias("n"), F.sum("s.hit").alias("rejected"))
    chance = failure / max(1, strata * len(names))

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        best = None
        for row in group.sort_values("step").itertuples():
            if not holds(int(row.rejected), int(row.n), risk / len(names), chance):
                break
            best = row
        return pd.DataFrame([] if best is None else [(best.stratum, best.rule, best.cutoff)], columns=["stratum", "rule", "cutoff"])

    return counted.groupBy("stratum", "rule").applyInPandas(choose, "stratum string, rule string, cutoff double")


def _figures() -> dict:
    return {name: F.expr(f"cast({figure} as double)") for name, figure, _ in RULES}


def _with_stratum(table: DataFrame, stratum: str) -> DataFrame:
    return table.withColumn("_stratum", F.coalesce(F.col(f"_row.{stratum}").cast("string"), F.lit("")))


def fit_cutoffs(table: DataFrame, labels: DataFrame, doc_id: str) -> DataFrame:
    """(_stratum, _cutoffs): proven cutoffs by rule for each stratum, from measured documents and labels (doc_id, quality)."""
    good = labels.where("quality = 1").select(F.col("doc_id").alias("_id")).distinct()
    labelled = table.where("not base_failed").select(F.col(f"_row.{doc_id}").alias("_id"), F.col("_stratum").alias("stratum"), *[f.alias(n) for n, f in _figures().items()])
    strata = table.select("_stratum").distinct().count()
    chosen = stored(cutoffs(labelled.join(good, "_id"), strata))
    return chosen.groupBy(F.col("stratum").alias("_stratum")).agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cutoffs"))


def _decided(table: DataFrame, chosen: DataFrame) -> DataFrame:
    out = table.join(chosen, "_stratum", "left")
    failed = F.filter(F.array(*[F.when(f > F.try_element_at("_cutoffs", F.lit(n)), F.lit(n)) for n, f in _figures().items()]), lambda x: x.isNotNull())
    return out.withColumn("failed_rules", failed).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", stratum: str = "lang") -> DataFrame:
    """Every row of ``docs`` as ``_row`` (see ``tables.packed``) with COUNTS, base_failed, failed_rules and kept.

    ``labels`` (doc_id, quality): rows with quality 1 are the holdout of good documents; documents that the base rule
    rejects are left out, as the cutoffs judge the others. A null stratum is a stratum of its own. Where
    too few are labelled to prove a rule's limit, the rule is off in that stratum and only the base rule acts.
    Null and empty texts have no words and fail the base rule. Repeated rows and ids are judged one by one.
    """
    table = _with_stratum(stored(measured(docs, text, ("_row",))), stratum)
    return _decided(table, fit_cutoffs(table, labels, doc_id)).select("_row", *COUNTS, "base_failed", "failed_rules", "kept")


def good_documents(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", stratum: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they were.

    Cutoffs come from a table of figures without texts; texts are then measured once more as they pass, so no copy of them is stored.
    """
    slim = docs.select(*dict.fromkeys([doc_id, stratum, text]))
    chosen = fit_cutoffs(_with_stratum(stored(measured(slim, text, ("_row",))), stratum), labels, doc_id)
    passing = _with_stratum(measured(docs, text), stratum)
    return unpacked(_decided(passing, chosen).where("kept"), docs.columns, text)
