import zlib
from collections import Counter
from hashlib import sha256

import cases
from pyspark.sql import functions as F

from storelens.llm import merkle, queries

FIELDS = queries.OP11_FIELDS


def h(text):
    return sha256(text.encode()).hexdigest()


def plain_leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves):
    """Root, and the siblings of every leaf level by level."""
    paths, members, nodes = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(nodes) > 1:
        runs = [range(k, min(k + 8, len(nodes))) for k in range(0, len(nodes), 8)]
        for run in runs:
            for k in run:
                for i in members[k]:
                    paths[i].append((run.index(k), [nodes[j] for j in run if j != k]))
        members = [[i for k in run for i in members[k]] for run in runs]
        nodes = [h("".join(nodes[k] for k in run)) for run in runs]
    return nodes[0], paths


def plain(rows, later):
    """rows: (doc_id, source, lang, n_chars, text). Digest columns of every row in the order of the query."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[g] = plain_tree([plain_leaf(r) for r in groups[g]])
    root, tops = plain_tree([trees[g][0] for g in order])
    out = []
    for g, top in zip(order, tops):
        for r, path in zip(groups[g], trees[g][1]):
            whole, start = path + top, plain_leaf(later(r))
            for i, others in whole:
                start = h("".join(others[:i]) + start + "".join(others[i:]))
            out.append((r[0], plain_leaf(r), trees[g][0], root, h("".join(x for _, s in whole for x in s)), start, start == root))
    return Counter(out)


def lower_third(r):
    if r[0] is None or zlib.crc32(str(r[0]).encode()) % 3 or r[4] is None:
        return r
    return (*r[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4]))


def found(docs):
    changed = merkle.leaf([merkle.tampered(F.col(c)) if c == "text" else F.col(c) for c in FIELDS])
    built = merkle.manifest(docs, FIELDS, carry={"later": F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, changed)})
    path = F.col("path")
    rows = built.proofs().select("key", "leaf", "subroot", F.lit(built.root).alias("root"), merkle.proof_digest(path), merkle.folded(F.coalesce("later", "leaf"), path).alias("f"))
    return built, Counter((*r, r["f"] == built.root) for r in rows.collect())


def test_awkward_rows_like_brute_force(spark):
    rows = [(r[0], r[3], r[2], r[4], r[1]) for r in cases.rows()]
    built, got = found(cases.documents(spark))
    assert got == plain(rows, lower_third)
    assert {r[6] for r in got} == {True, False}


def test_trees_of_every_height_like_brute_force(spark):
    """Groups of 1, 8, 9, 64, 65, 513 and 4,100 rows: one to three stored levels, last runs of one node."""
    sizes = {"a": 1, "b": 8, "c": 9, "d": 64, "e": 65, "f": 513, "é": 4100, None: 2}
    rows, n = [], 0
    for g, size in sizes.items():
        for _ in range(size):
            rows.append((n * 7919 % 5003, "s", g, n, f"Text {n}"))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    built, got = found(docs)
    assert got == plain(rows, lower_third)
    assert len(built.groups.levels) == 3


def test_many_groups_and_no_rows(spark):
    rows = [(n, None, f"l{n % 70}", None, None) for n in range(150)]
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    built, got = found(spark.createDataFrame(rows, schema))
    assert got == plain(rows, lower_third)
    assert len(built.top.levels) == 2
    built, got = found(cases.empty(spark))
    assert built.root is None and not got


def test_only_every_second_level_is_stored(spark):
    rows = [(n, "s", "x", n, "t") for n in range(600)]
    built, _ = found(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))
    held = [level.selectExpr("explode(nodes)").count() for level in built.groups.levels]
    assert held == [600, 10]  # 75 and 2 nodes lie between and are recomputed
    assert built.groups.levels[0].selectExpr("max(size(nodes))").first()[0] == merkle.SPAN


def test_a_changed_row_does_not_verify(spark):
    docs = spark.createDataFrame([(n, "s", "x", n, f"t{n}") for n in range(20)], "doc_id long, source string, lang string, n_chars long, text string")
    built = merkle.manifest(docs, FIELDS)
    rows = built.proofs().select("key", merkle.folded(F.lit("0" * 64), F.col("path")).alias("f"), merkle.folded(F.col("leaf"), F.col("path")).alias("t")).collect()
    assert all(r["t"] == built.root != r["f"] for r in rows)
