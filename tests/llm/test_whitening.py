import math
from fractions import Fraction

import cases
import numpy as np

from storelens.llm import queries, whitening


def plain(rows):
    """Whitening by numpy: (n, S, eigenvalues falling, vectors by column, trace) of the distinct integer vectors."""
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(v) for _, v in kept})
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    m = np.array([[float(Fraction(n * sum(v[i] * v[j] for v in fit) - total[i] * total[j], n * n)) for j in range(len(total))] for i in range(len(total))])
    values, vectors = np.linalg.eigh(m)
    return kept, n, total, values[::-1], vectors[:, ::-1], np.trace(m)


def check(rows, found, count):
    kept, n, total, values, vectors, trace = plain(rows)
    by_component = {}
    for r in found:
        by_component.setdefault(r["component"], []).append(r)
    assert sorted(by_component) == list(range(1, count + 1))
    for c, got in by_component.items():
        want = sorted((i is not None, i or 0, sum((n * x - s) ** 2 for x, s in zip(v, total)), v) for i, v in kept)
        got = sorted(got, key=lambda r: (r["vec_id"] is not None, r["vec_id"] or 0, r["deviation"]))
        assert [(r["vec_id"], r["deviation"], r["n"]) for r in got] == [(i if known else None, q, n) for known, i, q, _ in want]
        white = np.array([(np.array(v) - np.array(total) / n) @ vectors[:, c - 1] / np.sqrt(values[c - 1]) for *_, v in want])
        ours = np.array([r["whitened"] for r in got])
        assert min(np.abs(ours - white).max(), np.abs(ours + white).max()) < 1e-8
        assert all(abs(r["explained"] - values[c - 1] / trace) < 1e-9 and 0 <= r["identity_error"] < 1e-9 for r in got)


def test_query_like_numpy(spark):
    table = cases.table("embeddings")
    check(list(zip(table["vec_id"], table["embedding"])), queries.op12_whitening(spark, cases.SF).collect(), 4)


def test_awkward_vectors(spark):
    r = np.random.default_rng(3)
    good = [(i, [float(np.float32(c)) for c in r.normal(size=3) * [3, 1, 0.2]]) for i in range(40)]
    rows = [*good, good[0], (7, good[1][1]), (None, good[2][1]), (50, None), (51, [1.0, None, 2.0]), (52, [1.0, math.nan, 0.0]), (53, [math.inf, 0.0, 0.0]), (54, [-0.0, 0.0, 1e-9])]
    table = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], "vec_id long, embedding array<float>, key string, vector int, `a.b` int").repartition(3)
    check(rows, whitening.whiten(table).collect(), 3)
    odd = table.union(spark.createDataFrame([(60, [1.0], "x", 1, 2), (61, [], "x", 1, 2)], table.schema))
    check(rows, whitening.whiten(odd).collect(), 3)  # other lengths than the commonest are dropped


def test_nothing_to_whiten(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [])], [(1, [0.5, 0.5])], [(1, [0.5, 0.5]), (2, [0.5, 0.5])]):
        found = whitening.whiten(spark.createDataFrame(rows, schema))
        assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and found.count() == 0
    assert {r["component"] for r in whitening.whiten(spark.createDataFrame([(1, [0.5, 0.0]), (2, [0.5, 1.0])], schema)).collect()} == {1}


def test_equal_eigenvalues_get_orthogonal_components(spark):
    rows = [(i, [(1.0 if i % 3 == k else 0.0) * (1 if i < 3 else -1) for k in range(3)]) for i in range(6)]
    fitted, distinct = whitening.fit(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "embedding")
    v = np.array(fitted.vectors)
    assert np.abs(v @ v.T - np.eye(3)).max() < 1e-15 and max(fitted.values) - min(fitted.values) < 1e-12
    assert whitening.identity_error(fitted, distinct) < 1e-12


def exact_polynomial(m):
    """Faddeev-LeVerrier in fractions."""
    d = len(m)
    c, k = [Fraction(0)] * d + [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
    for i in range(1, d + 1):
        for j in range(d):
            k[j][j] += c[d - i + 1]
        k = [[sum(Fraction(m[a][x]) * k[x][b] for x in range(d)) for b in range(d)] for a in range(d)]
        c[d - i] = -sum(k[j][j] for j in range(d)) / i
    return [int(x) for x in c]


def test_polynomial_is_exact(spark):
    r = np.random.default_rng(1)
    for d, size in ((1, 5), (2, 10**6), (7, 10**9), (9, 3)):
        a = [[int(x) for x in row] for row in r.integers(-size, size, (d, d))]
        m = [[sum(a[k][i] * a[k][j] for k in range(d)) for j in range(d)] for i in range(d)]
        assert whitening.characteristic_polynomial(spark, m) == exact_polynomial(m)
    blocks = [[2, 0, 0, 0], [0, 2, 0, 0], [0, 0, 5, 1], [0, 0, 1, 5]]  # nothing below the diagonal to eliminate
    assert whitening.characteristic_polynomial(spark, blocks) == exact_polynomial(blocks)


def test_roots_are_counted_and_enclosed():
    p = [1]
    for root in (0, 4, 4, 9):
        p = [b - root * a for a, b in zip([*p, 0], [0, *p])]
    assert [whitening.roots_beyond(p, a) for a in (-1, 0, 3, 4, 8, 9)] == [4, 3, 3, 1, 1, 0]
    found = whitening.largest_roots(p, 6)
    assert [round(float(x), 20) for x in found] == [9.0, 4.0, 4.0, 0.0]
    assert abs(float(whitening.largest_roots([2, -4, 1], 1)[0]) - (2 + math.sqrt(2))) < 1e-15


def test_sums_beyond_a_long(spark):
    big = [[2**62, -(2**61)], [2**62 - 5, 3]]
    table = spark.createDataFrame([(np.array(v, "<i8").tobytes(),) for v in big], "x binary")
    n, total, gram = whitening.sums(table, 2)
    assert (n, total) == (2, [sum(c) for c in zip(*big)]) and gram == [[sum(v[i] * v[j] for v in big) for j in range(2)] for i in range(2)]
