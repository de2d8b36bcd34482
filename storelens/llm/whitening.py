"""Whitening of embeddings by exact arithmetic: integer scatter, its characteristic polynomial, isolated roots, null spaces.

Vectors become integers, so that the scatter n * sum(x x') - S S' of the distinct ones is an integer matrix and Spark adds it up without
rounding. Its characteristic polynomial is found modulo many primes (one row a prime, Hessenberg reduction in tasks)
and put together by Chinese remaindering. All its roots are real, so Descartes' rule counts the roots beyond a point exactly, and bisection
encloses each as finely as wanted, repeated ones too. Components come from inverse iteration at these roots in long decimals.
What the driver holds grows with the number of dimensions only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm.tables import stored

#: Fixed point of the entries (fixed by the contract): x = floor(SCALE * c).
SCALE = 256
COMPONENTS = 4
#: Bits behind the point to which roots are enclosed, and relative bits after which bisection stops.
FINE, SHARP = 96, 160
#: Decimals of inverse iteration. Roots closer than NEAR of the largest are one eigenspace.
DIGITS, NEAR = 120, Decimal(10) ** -26
#: A sum of integers travels as limbs of so many bits, each a long.
_LIMB, _LIMBS = 40, 5


# -- vectors as integers -------------------------------------------------------------------------------------------------


def _integers(vectors: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors are whole (d finite entries), and these as rows of longs."""
    sizes = np.asarray(vectors.value_lengths().fill_null(-1)).astype(np.int64) if len(vectors) else np.zeros(0, np.int64)
    good = sizes == d
    kept = vectors.filter(pa.array(good))
    values = kept.flatten()
    entries = np.asarray(values.cast(pa.float64()).fill_null(np.nan), np.float64).reshape(-1, d)
    whole = np.isfinite(entries).all(axis=1)
    good[good] = whole
    scaled = np.floor(SCALE * entries[whole])
    top = np.float64(2**63)
    return good, np.where(scaled >= top, np.iinfo(np.int64).max, np.clip(scaled, -top, np.nextafter(top, 0)).astype(np.int64))


def _dimension(rows: DataFrame, vector: str) -> int:
    """The commonest length of a vector; the longest on a tie. 0 without vectors."""
    sizes = rows.where(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("d")).count().where("d > 0")
    first = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return first["d"] if first else 0


def _packed(x: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in np.ascontiguousarray(x, "<i8")]


def _matrix(packed: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed.to_pylist()), "<i8").reshape(-1, d)


def distinct_vectors(rows: DataFrame, vector: str, d: int) -> DataFrame:
    """(x): every vector that is left, as packed longs, once. Copies are combined before the shuffle."""

    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_packed(_integers(batch.column(0), d)[1]), pa.binary())], names=["x"])

    return rows.select(vector).mapInArrow(integers, "x binary").distinct()


# -- exact sums ----------------------------------------------------------------------------------------------------------


def _limbs(value: int) -> list[int]:
    return [(value >> (_LIMB * k)) & ((1 << _LIMB) - 1) for k in range(_LIMBS - 1)] + [value >> (_LIMB * (_LIMBS - 1))]


def _exact_product(x: np.ndarray) -> np.ndarray:
    """x' x in exact integers: machine arithmetic where it can't overflow, else Python's."""
    if not len(x):
        return np.zeros((x.shape[1], x.shape[1]), object)
    top = max(abs(int(x.max())), abs(int(x.min())))
    if top * top * len(x) < 2**53:  # doubles hold such integers exactly, and their product is fast
        y = x.astype(np.float64)
        return (y.T @ y).astype(np.int64).astype(object)
    if top * top * len(x) < 2**63:
        return (x.T @ x).astype(object)
    y = x.astype(object)
    return y.T.dot(y)


def sums(fit: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """n, S and sum(x x') over the fit list, exact. A task hands on one row an entry; entries are added up by Spark."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, gram = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            x = _matrix(batch.column(0), d)
            n += len(x)
            total = total + np.array([int(v) for v in x.astype(object).sum(axis=0)], object) if len(x) else total
            gram = gram + _exact_product(x)
        values = [n, *total.tolist(), *(gram[i, j] for i in range(d) for j in range(i, d))]
        cells = [_limbs(int(v)) for v in values]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(cells)), pa.int32()), *(pa.array([c[k] for c in cells], pa.int64()) for k in range(_LIMBS))],
                                         names=["cell", *(f"l{k}" for k in range(_LIMBS))])

    schema = "cell int, " + ", ".join(f"l{k} long" for k in range(_LIMBS))
    added = fit.mapInArrow(partial, schema).groupBy("cell").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(_LIMBS)])
    found = {r["cell"]: sum(r[f"l{k}"] << (_LIMB * k) for k in range(_LIMBS)) for r in added.collect()}  # a row an entry of the matrix
    if not found:
        return 0, [0] * d, [[0] * d for _ in range(d)]
    gram, at = [[0] * d for _ in range(d)], 1 + d
    for i in range(d):
        for j in range(i, d):
            gram[i][j] = gram[j][i] = found[at]
            at += 1
    return found[0], [found[1 + i] for i in range(d)], gram


def scatter(n: int, total: list[int], gram: list[list[int]]) -> list[list[int]]:
    """n squared times the covariance."""
    return [[n * g - a * b for g, b in zip(row, total)] for row, a in zip(gram, total)]


# -- characteristic polynomial --------------------------------------------------------------------------------------------


def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every n below 3 * 10^9."""
    if n % 2 == 0:
        return n == 2
    s = (n - 1 & 1 - n).bit_length() - 1
    for a in (2, 3, 5, 7):
        x = pow(a, n >> s, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(s - 1)):
            return False
    return True


def primes(bits: int) -> list[int]:
    """The largest primes under 2^31 whose product has more than ``bits`` bits, and one more as a witness."""
    found, have, p = [], 0, 1 << 31
    while have <= bits:
        p -= 1
        if _is_prime(p):
            found.append(p)
            have += p.bit_length() - 1
    while not _is_prime(p := p - 1):
        pass
    return [*found, p]


def hessenberg_polynomial(matrix: np.ndarray, p: int) -> np.ndarray:
    """Characteristic polynomial modulo ``p`` (coefficients from x^0 up) by similarity to Hessenberg form. Entries are below p < 2^31, so products fit a long."""
    h, d = matrix % p, len(matrix)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        i = k + 1 + below[0]
        if i != k + 1:
            h[[k + 1, i]] = h[[i, k + 1]]
            h[:, [k + 1, i]] = h[:, [i, k + 1]]
        ratio = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - ratio[:, None] * h[k + 1]) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * ratio % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)  # row k: polynomial of the leading k x k block
    polys[0, 0] = 1
    for k in range(1, d + 1):
        polys[k, 1:] = polys[k - 1, :-1]
        weights, chain = np.zeros(k, np.int64), 1
        for i in range(k - 1, -1, -1):
            weights[i] = h[i, k - 1] * chain % p
            chain = chain * int(h[i, i - 1]) % p if i else 0
        polys[k] = (polys[k] - (weights[:, None] * polys[:k] % p).sum(axis=0)) % p
    return polys[d]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients of det(x - M), from x^0 up, of a positive semidefinite integer matrix.

    By Maclaurin's inequality the k-th coefficient is at most C(d, k) (trace / d)^k, which says how many primes are needed. Each prime is a row.
    """
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    bound = max(comb(d, k) * (trace // d + 1) ** k for k in range(d + 1))
    wanted = primes(bound.bit_length() + 1)

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            each = [hessenberg_polynomial(np.array([[v % p for v in row] for row in matrix], np.int64), p).tolist() for p in batch["p"].tolist()]
            yield pd.DataFrame({"p": batch["p"], "coefficients": each})

    rows = spark.createDataFrame([(p,) for p in wanted], "p long").repartition(min(len(wanted), 64))
    residues = {r["p"]: r["coefficients"] for r in rows.mapInPandas(reduce, "p long, coefficients array<long>").collect()}
    values, product = [0] * (d + 1), 1
    for p in wanted[:-1]:
        step = pow(product, -1, p)
        values = [v + product * ((r - v) * step % p) for v, r in zip(values, residues[p])]
        product *= p
    values = [v - product if 2 * v > product else v for v in values]
    if any((v - r) % wanted[-1] for v, r in zip(values, residues[wanted[-1]])):
        raise ArithmeticError("coefficients do not agree with the witness prime")
    return values


# -- roots ----------------------------------------------------------------------------------------------------------------


def roots_beyond(polynomial: list[int], a: int) -> int:
    """How many roots exceed ``a``, copies counted: sign changes of p(x + a), exact as all roots are real."""
    c = list(polynomial)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += a * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def largest_roots(polynomial: list[int], count: int) -> list[Decimal]:
    """The ``count`` largest roots, none negative, each enclosed within 2^-FINE or one part in 2^SHARP by bisection; a root of zero is exact."""
    d = len(polynomial) - 1
    fine = [c << (FINE * (d - i)) for i, c in enumerate(polynomial)]  # its roots are 2^FINE times as large
    top = (-polynomial[d - 1] << FINE) + 1  # none exceeds the sum of all
    known = {0: roots_beyond(fine, 0), top: 0}

    def beyond(a: int) -> int:
        if a not in known:
            known[a] = roots_beyond(fine, a)
        return known[a]

    out = []
    with localcontext(prec=DIGITS):
        for i in range(1, min(count, d) + 1):
            if beyond(0) < i:
                out.append(Decimal(0))
                continue
            low, high = max(a for a, n in known.items() if n >= i), min(a for a, n in known.items() if n < i)
            while high - low > 1 + (low >> SHARP):
                middle = (low + high) // 2
                low, high = (middle, high) if beyond(middle) >= i else (low, middle)
            out.append(Decimal(low + high) / Decimal(2 ** (FINE + 1)))
    return out


# -- components -----------------------------------------------------------------------------------------------------------


def _solver(matrix: list[list[int]], root: Decimal):
    """LU factors of M - root with row exchanges; a pivot of zero becomes the last digit's size."""
    d = len(matrix)
    a = [[Decimal(v) - root if i == j else Decimal(v) for j, v in enumerate(row)] for i, row in enumerate(matrix)]
    tiny = max(Decimal(1), root) * Decimal(10) ** (10 - DIGITS)
    order = list(range(d))
    for k in range(d):
        best = max(range(k, d), key=lambda i: abs(a[i][k]))
        a[k], a[best] = a[best], a[k]
        order[k], order[best] = order[best], order[k]
        a[k][k] = a[k][k] or tiny
        for i in range(k + 1, d):
            a[i][k] = ratio = a[i][k] / a[k][k]
            if ratio:
                upper, lower = a[k], a[i]
                for j in range(k + 1, d):
                    lower[j] -= ratio * upper[j]

    def solve(b: list[Decimal]) -> list[Decimal]:
        y = [b[i] for i in order]
        for i in range(d):
            y[i] -= sum((a[i][j] * y[j] for j in range(i)), Decimal(0))
        for i in reversed(range(d)):
            y[i] = (y[i] - sum((a[i][j] * y[j] for j in range(i + 1, d)), Decimal(0))) / a[i][i]
        return y

    return solve


def _unit(v: list[Decimal]) -> list[Decimal]:
    top = max(map(abs, v))
    scaled = [x / top for x in v]
    length = sum((x * x for x in scaled), Decimal(0)).sqrt()
    return [x / length for x in scaled]


def _without(v: list[Decimal], others: list[list[Decimal]]) -> list[Decimal]:
    for u in others:
        along = sum((x * y for x, y in zip(v, u)), Decimal(0))
        v = [x - along * y for x, y in zip(v, u)]
    return v


def components(matrix: list[list[int]], roots: list[Decimal]) -> list[list[float]]:
    """A unit vector of the null space of M - root for each root, by inverse iteration; equal roots get orthogonal ones.

    The first sizeable entry is positive, so that a run can be repeated.
    """
    found: list[tuple[Decimal, list[Decimal]]] = []
    with localcontext(prec=DIGITS):
        for number, root in enumerate(roots):
            solve = _solver(matrix, root)
            alike = [v for r, v in found if abs(r - root) <= NEAR * max(roots)]
            v = [Decimal(1) / (1 + (i * 7 + number * 3) % 11) + i for i in range(len(matrix))]
            for _ in range(4):
                v = _unit(_without(_unit(solve(_unit(_without(v, alike)))), alike))
            first = next(x for x in v if abs(x) > Decimal("1e-9"))
            found.append((root, [x if first > 0 else -x for x in v]))
    return [[float(x) for x in v] for _, v in found]


# -- whitening ------------------------------------------------------------------------------------------------------------


@dataclass
class Whitening:
    """A fitted whitening: everything in it has the size of the dimension, not of the table."""

    n: int
    total: list[int]
    vectors: list[list[float]]
    values: list[float]  # eigenvalues of the covariance
    explained: list[float]
    polynomial: list[int]

    @property
    def d(self) -> int:
        return len(self.total)

    def project(self, x: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """Whitened coordinates of integer vectors, and the exact squared deviation n^2 |x - mean|^2 (None beyond a long)."""
        top = max([abs(int(x.max())), abs(int(x.min()))] if x.size else [0]) * self.n + max(map(abs, self.total), default=0)
        exact = np.int64 if top * top * max(self.d, 1) < 2**63 else object
        off = x.astype(exact) * self.n - np.array(self.total, exact)
        squares = (off * off).sum(axis=1).tolist()
        centred = off.astype(np.float64) / self.n
        scale = np.sqrt(np.array(self.values)) if self.values else np.zeros(0)
        white = centred @ np.array(self.vectors, np.float64).reshape(-1, self.d).T / scale
        return white, [v if v < 2**63 else None for v in squares]


def fit(rows: DataFrame, vector: str, components_wanted: int = COMPONENTS) -> tuple[Whitening, DataFrame]:
    """Whitening fitted to the distinct integer vectors of ``rows``, and these vectors (stored)."""
    d = _dimension(rows, vector)
    if not d:
        return Whitening(0, [], [], [], [], []), rows.sparkSession.createDataFrame([], "x binary")
    distinct = stored(distinct_vectors(rows, vector, d))
    n, total, gram = sums(distinct, d)
    matrix = scatter(n, total, gram)
    trace = sum(matrix[i][i] for i in range(d))
    if not trace:
        return Whitening(n, total, [], [], [], []), distinct
    polynomial = characteristic_polynomial(rows.sparkSession, matrix)
    roots = [r for r in largest_roots(polynomial, components_wanted) if r > 0]
    with localcontext(prec=DIGITS):
        values, explained = [float(r / n / n) for r in roots], [float(r / trace) for r in roots]
    return Whitening(n, total, components(matrix, roots), values, explained, polynomial), distinct


def identity_error(fitted: Whitening, distinct: DataFrame) -> float:
    """Largest absolute entry of (covariance of the whitened fit list - identity); centred before multiplying."""
    k, model = len(fitted.values), fitted

    def white(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, _ = model.project(_matrix(batch.column(0), model.d))
            yield pa.RecordBatch.from_arrays([pa.array(found[:, i]) for i in range(k)], names=[f"w{i}" for i in range(k)])

    table = stored(distinct.mapInArrow(white, ", ".join(f"w{i} double" for i in range(k))))
    means = table.agg(*[F.avg(f"w{i}").alias(f"w{i}") for i in range(k)]).first()
    off = [F.col(f"w{i}") - F.lit(means[i]) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = table.agg(*[(F.sum(off[i] * off[j]) / F.lit(fitted.n)).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[q] - (i == j)) for q, (i, j) in enumerate(pairs))


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components_wanted: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) for every row that has a whole vector.

    Dropped: null vectors, vectors with a null, infinite or not-a-number entry, empty ones, and those whose length is not the commonest one.
    Copies of a row all come back; the fit takes each distinct integer vector once. Null keys stay null. Components whose eigenvalue is
    zero have no whitened coordinate and are left out, so there are fewer of them in few dimensions or among few vectors, and none where all vectors
    are equal. ``deviation`` is null beyond a long. An empty table gives an empty table. Other columns may have any name.
    """
    named = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("vector"))
    fitted, distinct = fit(named, "vector", components_wanted)
    k, n = len(fitted.values), fitted.n
    error = identity_error(fitted, distinct) if k else None
    explained, d = fitted.explained, fitted.d

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, x = _integers(batch.column(1), d)
            white, squares = fitted.project(x)
            m = len(x)
            keys = batch.column(0).filter(pa.array(good))
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                 pa.array([v for v in squares for _ in range(k)], pa.int64()), pa.array(white.reshape(-1)), pa.array(np.tile(np.array(explained), m)),
                 pa.array(np.full(m * k, error, np.float64))],
                names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    kind = named.schema["key"].dataType.simpleString()
    out = named if k else named.limit(0)
    return out.mapInArrow(run, f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double").withColumnRenamed("key", key)
