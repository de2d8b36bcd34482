import zlib
from collections import Counter

import cases
import numpy as np
import pyarrow as pa

from storelens.llm import quality


def test_features_are_those_of_each_text_alone():
    texts = [cases.TEXTS[0], None, "", "one one one", cases.TEXTS[9], "A!! B!! A!!", cases.prose(300, 1)]
    buckets, first = quality.features(pa.array(texts))
    for k, t in enumerate(texts):
        alone, _ = quality.features(pa.array([t], pa.string()))
        assert buckets[first[k] : first[k + 1]].tolist() == alone.tolist()
    assert first[1] == first[2] == first[3]
    assert all(len(set(buckets[a:b])) == b - a for a, b in zip(first, first[1:]))


def test_shapes_tell_signs_and_case_apart():
    def shapes(text):
        from storelens.llm import words as W

        data, offsets = W.buffers(pa.array([text]))
        return quality._shapes(data, *W.spans(data, offsets, quality._NOT_SPACE)[:2]).tolist()

    a = shapes(" Word Other word### WORD x1y word##")
    assert a[0] == a[1] and a[2] == a[5] and len({a[0], a[2], a[3], a[4]}) == 4


def test_dual_descent_reaches_the_optimum():
    r = np.random.default_rng(2)
    rows = [np.flatnonzero(r.random(30) < 0.3).astype(np.int32) for _ in range(120)]
    y = np.where([len(set(x) & {1, 2, 3}) > 0 for x in rows], 1.0, -1.0)
    ratio = r.normal(size=30)
    w = quality.dual_descent(rows, y, ratio, epochs=400)
    x = np.zeros((120, 30))
    for i, row in enumerate(rows):
        x[i, row] = ratio[row] / np.sqrt(max(len(row), 1))
    loss = lambda w: 0.5 * w @ w + np.maximum(0, 1 - y * (x @ w)).sum()
    best = min(loss(w + step) for step in r.normal(scale=0.02, size=(400, 30)))
    assert loss(w) <= best + 1e-6 and loss(w) < loss(np.zeros(30))


def test_held_out_quality(spark):
    from storelens.llm.queries import op1_quality

    sf = cases.SF.replace("0.001", "0.01")
    label = dict(zip(*[cases.table("labels", sf)[c] for c in ("doc_id", "quality")]))
    rows = op1_quality(spark, sf).collect()
    assert Counter(r.doc_id for r in rows) == Counter(cases.table("documents", sf)["doc_id"])
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    good = np.array([r.score for r in rows if r.held_out and label.get(r.doc_id) == 1])
    bad = np.array([r.score for r in rows if r.held_out and label.get(r.doc_id) == 0])
    assert (good[:, None] > bad).mean() > 0.95


def test_counts_cover_all_labelled_rows(spark, monkeypatch):
    rows = [(cases.prose(20, k), k % 2 == 0, (k * 37 % 50) / 50) for k in range(50)]
    seen = {}
    monkeypatch.setattr(quality, "fit", lambda sample, good, ratio: seen.update(n=len(sample), good=good, ratio=ratio))
    quality.train(spark.createDataFrame(rows, "_text string, good boolean, pick double").repartition(3), 50, 10)
    assert seen["n"] == 10
    counts = np.ones((2, quality.BUCKETS))
    for t, g, _ in rows:
        counts[int(g), quality.features(pa.array([t]))[0]] += 1
    want = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    want[(counts == 1).all(axis=0)] = 0
    assert np.allclose(seen["ratio"], want)


def test_awkward_documents(spark):
    docs, labels = cases.documents(spark), cases.labels(spark)
    found = quality.score_quality(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if not (r._text or "").strip()}) == 1
    assert quality.score_quality(cases.empty(spark), labels).count() == 0
    assert {r.score for r in quality.score_quality(docs, labels.limit(0)).collect()} == {0.5}


def test_labels_by_shuffle_give_the_same(spark, monkeypatch):
    docs, labels = cases.documents(spark), cases.labels(spark)
    scores = lambda: sorted((r._text or "", round(r.score, 9)) for r in quality.score_quality(docs, labels).collect())
    sent = scores()
    monkeypatch.setattr(quality, "SENT_ROWS", 0)
    assert scores() == sent
