import random
import re
from collections import Counter

import cases
import numpy as np
import xxhash

from storelens.llm import simhash
from storelens.llm.components import components


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in hashes) > len(hashes))


def plain_components(fps, bits=3):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    nodes = sorted(root)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in nodes}


def test_awkward_documents_like_brute_force(spark):
    rows = cases.rows()
    found = simhash.near_copies(cases.documents(spark), carry=("_row",))
    fps = {i: plain_fingerprint(r[1]) for i, r in enumerate(rows)}
    group = plain_components(fps.values())
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[group[fps[i]]] = min(least.get(group[fps[i]], r[0]), r[0])
    want = Counter((r[0], fps[i], least.get(group[fps[i]])) for i, r in enumerate(rows))
    got = Counter((r[0], r[1] & (2**64 - 1), r[2]) for r in found.select("_row.doc_id", "fp", "component_id").collect())
    assert got == want


def spread(n, seed):
    r = random.Random(seed)
    out = set()
    for _ in range(n // 6):
        f = r.getrandbits(64)
        for _ in range(6):
            out.add(f)
            for _ in range(r.randint(0, 5)):
                f ^= 1 << r.randrange(64)
    return sorted(out)


def links_roots(spark, fps, group):
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    roots = {r.node: r.root for r in components(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), group)).collect()}
    classes = {}
    for x in signed:
        classes.setdefault(roots.get(x, x), set()).add(x & (2**64 - 1))
    return {frozenset(c) for c in classes.values()}


def plain_classes(fps):
    classes = {}
    for f, root in plain_components(fps).items():
        classes.setdefault(root, set()).add(f)
    return {frozenset(c) for c in classes.values()}


def test_links_lose_no_component(spark):
    fps = spread(600, 3)
    assert links_roots(spark, fps, 4096) == plain_classes(fps)


def test_large_groups_are_refined_without_loss(spark):
    base = 0x1234_5678_9ABC_DEF0  # many fingerprints share most bytes, so keys are refined several times
    r = random.Random(8)
    fps = sorted({base ^ sum(1 << b for b in r.sample(range(24), r.randint(0, 9))) for _ in range(250)} | set(spread(60, 4)))
    assert links_roots(spark, fps, 5) == plain_classes(fps)


def test_refinements_cover_every_linked_pair():
    r = random.Random(2)
    masks = list(simhash.TRIPLES)
    while masks:
        longer = {}
        for m in masks:
            longer[m] = simhash.refinements(m)
        for _ in range(300):
            a = r.getrandbits(64)
            b = a
            for p in r.sample(range(64), r.randint(1, 3)):
                b ^= 1 << p
            for m in masks:
                if (a ^ b) & m == 0 and longer[m]:
                    assert any((a ^ b) & x == 0 for x in longer[m])
        masks = sorted({x for v in longer.values() for x in v})[:40]


def test_every_linked_pair_shares_a_triple():
    r = random.Random(1)
    for _ in range(2000):
        x = 0
        for p in r.sample(range(64), 3):
            x ^= 1 << p
        assert any(x & m == 0 for m in simhash.TRIPLES)


def test_spanning_forest_joins_what_is_linked():
    fps = spread(300, 9)
    nodes, roots = simhash._linked(np.array(fps, np.uint64))
    root = {f: f for f in fps}
    root.update(zip(map(int, nodes), map(int, roots)))
    classes = {}
    for f in fps:
        classes.setdefault(root[f], set()).add(f)
    assert {frozenset(c) for c in classes.values()} == plain_classes(fps)


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (300, 200), (300, 201)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {roots[i] for i in range(41)} == {0} and {roots[100 + i] for i in range(50)} == {100} and roots[201] == 200


def test_one_document_of_each_group_stays(spark):
    docs = cases.documents(spark)
    kept = simhash.distinct_documents(docs)
    assert kept.schema == docs.schema
    groups = simhash.near_copies(docs).select("first_uid").distinct().count()  # two components can have one id, as ids repeat
    assert kept.count() == groups
    assert simhash.distinct_documents(cases.empty(spark)).count() == 0


def test_long_texts_are_summed_in_parts(monkeypatch):
    text = cases.prose(500, 3)
    monkeypatch.setattr(simhash, "_CHUNK", 7)
    assert simhash.fingerprint(text) == plain_fingerprint(text)
