import zlib
from collections import Counter, defaultdict
from math import log

import cases
import numpy as np
import pyarrow as pa

from storelens.llm import language


def test_symbols_fold_case_and_runs():
    s, first = language.symbols(["Ab, ..c", "", "é1É"])
    lead = [0] * (language.ORDER - 1)
    a, b, c, accent = map(ord, "abcé")
    assert s.tolist() == [*lead, a, b, 0, c, *lead, *lead, accent, 0, accent]
    assert first.tolist() == [0, 7, 10, 16]


def test_grams_end_at_each_symbol():
    key, first = language.grams(["ab", "", "c"])
    a, b, c = map(ord, "abc")
    assert key.tolist() == [a, (a << language.BITS) + b, c] and first.tolist() == [0, 2, 2, 3]


def plain_model(texts):
    """Interpolated Kneser-Ney as in the textbook, with dictionaries."""
    order, size = language.ORDER, 1 << language.BITS
    counts = [Counter()]
    for t in texts:
        s, _ = language.symbols([t])
        for k in range(order - 1, len(s)):
            counts[0][tuple(s[k - order + 1 : k + 1].tolist())] += 1
    for _ in range(order - 1):
        counts.append(Counter(g[1:] for g in counts[-1]))
    levels = counts[::-1]

    def probability(gram, n):
        if n == 0:
            return 1 / size
        c = levels[n - 1]
        values = list(c.values())
        n1, n2 = values.count(1), values.count(2)
        d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        followers = totals[n][gram[-n:-1]]
        lower = probability(gram, n - 1)
        if not followers[0]:
            return lower
        return max(c[gram[-n:]] - d, 0) / followers[0] + d * followers[1] / followers[0] * lower

    totals = [defaultdict(lambda: [0, 0]) for _ in range(order + 1)]
    for n in range(1, order + 1):
        for g, c in levels[n - 1].items():
            totals[n][g[:-1]][0] += c
            totals[n][g[:-1]][1] += 1
    return lambda text: [-log(probability(tuple(language.symbols([text])[0][k - order + 1 : k + 1].tolist()), order)) for k in range(order - 1, len(language.symbols([text])[0]))]


def test_probabilities_are_kneser_neys():
    texts = {"a": [cases.prose(80, 1), "zebra ubu"], "b": ["été là où ça", "le la les un une"]}
    rows = []
    for name, given in texts.items():
        keys, n = np.unique(np.concatenate([language.grams([t])[0] for t in given]), return_counts=True)
        rows += [(name, int(k), int(c)) for k, c in zip(keys.view(np.int64), n)]
    model = language.fit(pa.table({"lang": [r[0] for r in rows], "gram": [r[1] for r in rows], "n": [r[2] for r in rows]}))
    for probe in ["zebra la", "qqq xyz", cases.prose(20, 5), "où 12", "мир 𐐀𐐨 ça"]:
        means, sizes = language.entropies(model, [probe, ""])
        for j, name in enumerate(model.languages):
            want = plain_model(texts[name])(probe)
            assert sizes[0] == len(want) and abs(means[0, j] - np.mean(want)) < 1e-4
    # all symbols together have probability one after a context that one language has and the other has not
    every = np.arange(1 << language.BITS, dtype=np.uint64)
    context = np.uint64((ord("z") << 2 * language.BITS) + (ord("e") << language.BITS) + ord("b")) << np.uint64(language.BITS)
    total = np.exp(model.log_probabilities(context + every).astype(np.float64)).sum(axis=0)
    assert np.allclose(total, 1, atol=1e-3)


def test_counts_cover_the_table(spark):
    rows = [(cases.prose(30, k), ["x", "y"][k % 2]) for k in range(40)] + [("", "x")]
    got = {(r.lang, r.gram): r.n for r in language.gram_counts(spark.createDataFrame(rows, "_text string, _lang string").repartition(5)).collect()}
    want = Counter((lang, int(k)) for t, lang in rows for k in language.grams([t])[0].view(np.int64))
    assert got == dict(want)


def test_held_out_accuracy(spark):
    from storelens.llm.queries import op7_language

    sf = cases.SF.replace("0.001", "0.01")
    truth = dict(zip(*[cases.table("documents", sf)[c] for c in ("doc_id", "lang")]))
    rows = op7_language(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert sum(held) / len(held) > 0.97
    assert sum(r.rejected for r in rows) <= 2


def test_awkward_documents(spark):
    docs = cases.documents(spark)
    found = language.identify(docs)
    assert found.count() == docs.count()
    for r in found.select("_text", "lang_pred", "score", "rejected").collect():
        if not any(map(str.isalpha, r._text or "")):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in ("en", "fr")
    assert language.known_language(docs).schema == docs.schema
    assert language.identify(cases.empty(spark)).count() == 0
    nothing = language.identify(docs, learn="false").collect()
    assert {r.lang_pred for r in nothing} == {"und"}


def test_foreign_text_is_rejected(spark):
    rows = [(k, cases.prose(60, k), "en") for k in range(300)]
    rows += [(1000, " ".join("qzxjkwvq" for _ in range(80)), None), (1001, cases.prose(60, 999), None)]
    found = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {r[0] for r in found.where("rejected").select("_row.doc_id").collect()} == {1000}


def _words(alphabet: str, seed: int, n: int = 60) -> str:
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list(alphabet), rng.integers(2, 8))) for _ in range(n))


def test_letters_of_one_script_are_told_apart(spark):
    """Languages that differ in some letters of one script only, and letters that a fold by code point would merge."""
    kinds = {"ru": "абвгдежзиклмнопрстуыэё", "uk": "абвгдежзиклмнопрстуіїєґ", "zh": "的一是不了人我在有他这为", "ja": "のにをはがでとたしいるな一人有", "hi": "कखगघचजतदनपबमािीुूे"}
    rows = [(100 * j + k, _words(letters, 100 * j + k), lang) for j, (lang, letters) in enumerate(kinds.items()) for k in range(60)]
    found = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = {r[0]: r[1] for r in found.where("not learned").select("_row.doc_id", "lang_pred").collect()}
    assert got and all(got[i] == lang for i, _, lang in rows if i in got)
    a, b = language.grams(["мама дам"])[0], language.grams(["щнщн снщ"])[0]
    assert len(a) == len(b) and not set(a) & set(b)


def test_a_script_that_was_not_learned_is_rejected(spark):
    rows = [(k, cases.prose(60, k), "en") for k in range(300)]
    rows += [(1000, _words("абвгдежзиклмнопрст", 1), None), (1001, _words("的一是不了人我在有", 2), None), (1002, cases.prose(60, 998), None)]
    found = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {r[0] for r in found.where("rejected").select("_row.doc_id").collect()} == {1000, 1001}


def test_calibration_rows_are_not_counted(spark, monkeypatch):
    counted = []
    inner = language.gram_counts
    monkeypatch.setattr(language, "gram_counts", lambda rows: (counted.append(rows.count()), inner(rows))[1])
    rows = [(k, cases.prose(40, k), "en") for k in range(400)]
    found = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    learned = found.where("learned").count()
    assert 0.8 * learned < counted[0] < learned


def test_parts_of_texts_add_up(spark, monkeypatch):
    """Lookups and counts in small parts give what whole texts give."""
    texts = [cases.prose(50, 1), "", cases.prose(3, 2), "1", cases.prose(90, 3)]
    rows = spark.createDataFrame([(t, "ab"[k % 2]) for k, t in enumerate(texts)], "_text string, _lang string").coalesce(1)
    counts = language.gram_counts(rows).toArrow()
    model = language.fit(counts)
    whole, sizes = language.entropies(model, texts)
    monkeypatch.setattr(language, "_AT_ONCE", 7)
    parts, again = language.entropies(model, texts)
    assert np.allclose(whole, parts, atol=1e-6) and (sizes == again).all()
    for k, t in enumerate(texts):
        assert np.allclose(language.entropies(model, [t])[0][0], whole[k], atol=1e-6)
