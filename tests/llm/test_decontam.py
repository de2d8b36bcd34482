import hashlib
import re
from collections import Counter

import cases
import pytest
from pyspark.sql import functions as F

from storelens.llm import decontam
from storelens.llm import words as W

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    grams = {}
    for item, text in items:
        w = words(text)
        for s in range(len(w) - min(window, len(w)) + 1 if w else 0):
            grams.setdefault(tuple(w[s : s + window]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(g) for g in grams}:
            for s in range(len(w) - k + 1):
                if g := grams.get(tuple(w[s : s + k])):
                    hit.update(range(s, s + k))
                    found |= g
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


def result(docs, items, **options):
    judged, _ = decontam.decontaminate(docs, items, carry=("_row",), **options)
    return Counter(tuple(r) for r in judged.select(F.col("_row.doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect())


def test_awkward_documents_like_brute_force(spark):
    docs, items = cases.documents(spark), cases.benchmark(spark)
    assert result(docs, items) == brute([r[:2] for r in cases.rows()], [tuple(r) for r in items.collect()])


def test_small_table_like_brute_force(spark):
    d, b = cases.table("documents"), cases.table("benchmark")
    docs, items = spark.read.parquet(f"{cases.SF}/documents.parquet"), spark.read.parquet(f"{cases.SF}/benchmark.parquet")
    assert result(docs, items) == brute(zip(d["doc_id"], d["text"]), zip(b["item_id"], b["text"]))


def test_items_in_blocks_give_the_same(spark, monkeypatch):
    docs, items = cases.documents(spark), cases.benchmark(spark)
    whole = result(docs, items)
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 15)
    assert result(docs, items) == whole


def test_repetitive_items_and_documents(spark):
    docs = [(1, "a b " * 40), (2, "a a a a a a a a a a a"), (3, "b a " * 5), (4, "a b a b")]
    items = [(1, "a b " * 8), (2, "a " * 12), (3, "a b a b a")]
    got = result(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert got == brute(docs, items)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert result(cases.empty(spark), cases.benchmark(spark)) == Counter()
    assert all(not k[5] for k in result(cases.documents(spark), none))


def test_proximity_takes_a_changed_word(spark):
    text = cases.TEXTS[0].split()
    changed = " ".join([*text[10:15], "changed", *text[16:30]])
    docs = spark.createDataFrame([(1, changed), (2, "nothing of it")], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(text[10:22]))], "item_id long, text string")
    judged, _ = decontam.decontaminate(docs, items)
    assert {r["doc_id"]: (r.n_hit, r.n_near) for r in judged.select("_row.doc_id", "n_hit", "n_near").collect()} == {1: (0, 1), 2: (0, 0)}


def brute_near(docs, items, window=10, near=8):
    out = {}
    for doc, text in docs:
        w, found = words(text), set()
        for item, given in items:
            v = words(given)
            shift = decontam.SHIFT if len(v) >= near else 0
            for s in range(max(len(v) - window, 0) + 1 if v else 0):
                for d in range(-len(v), len(w)):
                    best = {}  # longest chain of words in order that ends on a place of the document
                    for p in range(s, min(s + window, len(v))):
                        new = {p + o: 1 + max((c for q, c in best.items() if q < p + o), default=0) for o in range(d, d + shift + 1) if 0 <= p + o < len(w) and w[p + o] == v[p]}
                        best |= {q: max(c, best.get(q, 0)) for q, c in new.items()}
                    if max(best.values(), default=0) >= min(near, len(v)):
                        found.add(str(item))
        out[doc] = len(found)
    return out


def test_proximity_like_brute_force(spark):
    from random import Random

    draw = Random(5)
    rare = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(draw.choice(rare + ["the", "of"] * 8) for _ in range(n))) for k, n in enumerate([10, 10, 10, 12, 14, 9, 8, 7, 3, 1, 10, 10])]
    docs = [(900, " ".join(rare)), (901, "the of " * 20), (902, "")]
    for k, text in items:
        for changes in range(6):
            w = text.split()
            for _ in range(changes):
                at, kind = draw.randrange(len(w) + 1), draw.randrange(3)
                w[at : at + (kind > 0)] = [draw.choice(rare)] if kind < 2 else []
            docs.append((10 * k + changes, " ".join(["x", *draw.sample(rare, 3), *w, *draw.sample(rare, 2)])))
    ten = items[0][1].split()
    docs += [(1000 + k, " ".join([*ten[:k], "changed", *ten[k + 1 :]])) for k in range(10)]  # the rarest word is one of them
    docs += [(1010 + k, " ".join([*ten[:k], "changed", ten[k + 1], "changed", *ten[k + 3 :]])) for k in range(8)]  # both words beside one
    docs += [(1020 + k, " ".join([*ten[:k], "put", *ten[k:]])) for k in range(11)]
    judged, _ = decontam.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), carry=("_row",))
    got = {r.doc_id: r.n_near for r in judged.select("_row.doc_id", "n_near").collect()}
    assert got == brute_near(docs, items)
    assert all(got[k] for k in range(1000, 1031) if k not in (1018, 1019))


def test_clean_documents_keep_their_columns(spark):
    docs = cases.documents(spark)
    clean = decontam.clean_documents(docs, cases.benchmark(spark))
    assert clean.schema == docs.schema
    assert clean.count() == docs.count() - sum(bool(k[2]) * n for k, n in result(docs, cases.benchmark(spark)).items())


@pytest.mark.parametrize("text", ["Ab aB. ab_", "é éa é", "", "a" * 5000 + " b", "1a2 \x7f3 中"])
def test_spans_and_hashes_agree_with_the_pattern(text):
    import pyarrow as pa

    data, offsets = W.buffers(pa.array([text, None, text]))
    starts, ends, first = W.spans(data, offsets)
    raw = data.tobytes()
    assert [raw[a:b].lower().decode() for a, b in zip(starts[first[2] :], ends[first[2] :])] == words(text)
    h = W.hashes(data, starts, ends)
    assert list(h[: first[1]]) == list(h[first[2] :])
    assert len(set(h[: first[1]])) == len(set(words(text)))
