import random
import re
from collections import Counter

import cases
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from storelens.llm import minhash
from storelens.llm.components import components


def plain_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2))) if w else frozenset()


def plain(rows, percent=85):
    """(doc_id, n_shingles, component_id, kept) by comparing all sets with each other."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = least.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return Counter(out)


def found(docs):
    return Counter(tuple(r) for r in minhash.near_copies(docs).select("doc_id", "n_shingles", "component_id", "kept").collect())


def test_awkward_documents_like_brute_force(spark):
    rows = [(r[0], r[1]) for r in cases.rows()]
    rows += [(100, "Two Words"), (101, "two\twords"), (102, "words two"), (103, "two"), (104, cases.prose(60, 1).upper())]
    docs = cases.documents(spark).unionByName(spark.createDataFrame(rows[-5:], "doc_id long, text string"), allowMissingColumns=True)
    assert found(docs) == plain(rows)


def test_no_rows_and_no_links(spark):
    assert not found(cases.empty(spark))
    rows = [(i, cases.prose(30, 50 + i)) for i in range(6)] + [(9, None), (10, " ")]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)


def changed(words, share, r):
    return [r.choice(cases.VOCABULARY) + "x" if r.random() < share else w for w in words]


def chains(seed):
    """Chains of copies of copies, groups around one text, and pairs at all similarities around the limit."""
    r, rows, n = random.Random(seed), [], 0
    for group in range(12):
        base = cases.prose(r.choice([9, 40, 150]), 900 + 50 * seed + group).split()
        here = base
        for _ in range(r.randint(2, 14)):
            here = changed(base if group % 2 else here, r.choice([0.005, 0.02, 0.03, 0.05]), r)
            rows.append((n * 31 % 1009, " ".join(here)))
            n += 1
    return rows


def nodes_of(spark, rows):
    sets = minhash.shingle_sets(pa.array([t for _, t in rows]))
    seen, out = set(), []
    for (d, _), s in zip(rows, sets):
        if s.tobytes() not in seen:
            seen.add(s.tobytes())
            sign = minhash.signatures([s])
            out.append((d, minhash.band_keys(sign)[0].view(np.int64).tolist(), sign[0].astype(np.uint32).tobytes(), s.tobytes()))
    table = spark.createDataFrame(out, "node long, keys array<long>, signature binary, shingles binary")
    return table.drop("shingles"), lambda active: table.select("node", "shingles").join(active, "node")


def test_chains_like_brute_force(spark):
    rows = chains(1)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)


@pytest.mark.parametrize("large, block", [(10**9, 512), (10**9, 3), (2, 2)])
def test_leaders_and_tiles_lose_no_link(spark, large, block):
    """More turns of leaders, or buckets cut into blocks of two and three nodes: the same components."""
    rows = list({plain_set(t): (d, t) for d, t in chains(2)}.values())
    roots = {r["node"]: r["root"] for r in minhash.links(*nodes_of(spark, rows), block=block, large=large).collect()}
    want = {d: c for d, _, c, _ in plain(rows)}
    assert all(roots.get(d, d) == c for d, c in want.items())


def tiled(spark, rows, root):
    nodes, sets_of = nodes_of(spark, rows)
    together = nodes.join(sets_of(nodes.select("node")), "node").withColumn("root", root)
    return minhash._each_batch(together, minhash._compact, minhash._COMPACT, ["node", "root"])


def test_pairs_of_one_component_are_not_compared(spark):
    assert minhash._crossing(tiled(spark, chains(3), F.lit(0).cast("long")), 0, 1).count() == 0


def test_tiles_give_fewer_links_than_nodes(spark):
    """All of a group of similar texts are joined, by one link for each component that goes."""
    r = random.Random(8)
    base = cases.prose(200, 77).split()
    rows = [(i, " ".join(changed(base, 0.004, r))) for i in range(40)]
    tiles = tiled(spark, rows, F.col("node"))
    n = tiles.count()
    found = minhash._crossing(tiles, minhash.LEAST, 85)
    assert n - 1 <= found.count() <= 3 * n and components(found).select("root").distinct().count() == 1


def test_both_ends_estimate_similarity():
    """Without bias, and with less spread than as many permutations with minima alone."""
    r = np.random.default_rng(0)
    errors, minima = [], []
    for _ in range(300):
        both, a, b = (r.integers(0, 2**63, k, np.uint64) * np.uint64(2) for k in (60, 20, 20))
        s = minhash.signatures([np.concatenate([both, a]), np.concatenate([both, b])])
        same = s[0] == s[1]
        errors.append(same.mean() - 0.6)
        minima.append(same[::2].mean() - 0.6)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.8 * np.std(minima)


def test_bands_hold_pairs_at_the_limit():
    r, missed = np.random.default_rng(1), 0
    for _ in range(300):
        both, a, b = (r.integers(0, 2**63, k, np.uint64) for k in (170, 15, 15))
        keys = minhash.band_keys(minhash.signatures([np.concatenate([both, a]), np.concatenate([both, b])]))
        missed += not (keys[0] == keys[1]).any()
    assert missed == 0


def test_bitmap_keeps_all_that_is_wanted(spark, monkeypatch):
    rows = spark.range(2000).select(F.xxhash64("id").alias("t1"), F.lit("x").alias("_text"))
    wanted = rows.limit(50)
    kept = minhash._marked(rows, wanted)
    assert kept.join(wanted, "t1", "left_semi").count() == 50 and kept.count() < 60
    monkeypatch.setattr(minhash, "MARKS", 64)
    assert minhash._marked(rows, wanted).join(wanted, "t1", "left_semi").count() == 50


def test_few_keys_of_tiles_are_shared_by_texts_little_alike():
    """Pairs at 85 % meet; pairs at 5 % seldom do, so that tiles do not grow with the square of the table."""
    r, met, missed = np.random.default_rng(2), 0, 0
    for _ in range(200):
        for common, own, percent in ((170, 15, 85), (20, 190, 5)):
            both, a, b = (r.integers(0, 2**63, k, np.uint64) for k in (common, own, own))
            sets = [np.unique(np.concatenate([both, x])) for x in (a, b)]
            signs = [s.astype(np.uint32).tobytes() for s in minhash.signatures(sets)]
            part = pa.RecordBatch.from_arrays([pa.array(signs, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["signature", "shingles"])
            x, y = minhash._compact(part)[0].to_pylist()
            shared = len(set(x) & set(y))
            missed += percent == 85 and not shared
            met += shared if percent == 5 else 0
    assert missed == 0 and met < 40  # single values: about 120


def test_tiles_cut_by_batches_are_whole():
    """A tile whose rows come in several batches gives the links that it gives in one."""
    r = random.Random(9)
    texts = [" ".join(changed(cases.prose(200, 60 + g).split(), 0.004, r)) for g in range(3) for _ in range(4)]
    sets = minhash.shingle_sets(pa.array(texts))
    signs = [s.astype(np.uint32).tobytes() for s in minhash.signatures(sets)]
    part = pa.RecordBatch.from_arrays([pa.array(signs, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["signature", "shingles"])
    _, sign, small = minhash._compact(part)
    zero, node = pa.array([0] * 12, pa.int32()), pa.array(range(12), pa.int64())
    rows = pa.RecordBatch.from_arrays([pa.array([0] * 4 + [1] * 8, pa.int64()), zero, zero, zero, node, node, sign, small], names=minhash._TILE)

    def links(*batches):
        return [x for b in minhash._across(minhash.LEAST, 85)(iter(batches)) for x in zip(*(b.column(c).to_pylist() for c in "ab"))]

    whole = links(rows)
    assert len(whole) == 9 and whole == links(*[rows.slice(k, 1) for k in range(12)]) == links(rows.slice(0, 6), rows.slice(0, 0), rows.slice(6))
