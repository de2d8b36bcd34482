"""Quality scores by naive Bayes support vectors over word and word-shape n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm import words as W
from storelens.llm.tables import each_slice, packed, slices, stored

#: N-grams are hashed to so many buckets; models and class counts have this size whatever the corpus.
BUCKETS = 1 << 17
#: Labelled rows that the hinge-loss model is fitted on, about; class counts cover all labelled rows.
FIT_ROWS = 12_000
#: Up to so many labelled rows (two numbers each, at most 64 MB) are sent to every executor; more are joined by a shuffle.
SENT_ROWS = 4_000_000
EPOCHS = 20
PENALTY = 1.0
SMOOTHING = 1.0
THRESHOLD = 0.3

_NOT_SPACE = np.ones(256, bool)
_NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
# Shape of a byte: lower case and other letters, upper case, digits; every other sign stands for itself.
_CLASS = np.arange(256, dtype=np.uint64)
_CLASS[97:123], _CLASS[128:], _CLASS[65:91], _CLASS[48:58] = 1, 1, 2, 3
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's shape: its classes of signs with runs as one, so Word and Other agree, word### and WORD do not."""
    kind = _CLASS[data]
    turn = np.ones(len(data), bool)
    turn[1:] = kind[1:] != kind[:-1]
    turn[starts] = True
    rank = np.cumsum(turn)
    place = (rank - np.repeat(rank[starts], np.diff(np.append(starts, len(data))))) if len(starts) and starts[0] == 0 else None
    if place is None:  # the data do not begin with a word
        owner = np.maximum(np.searchsorted(starts, np.arange(len(data)), "right") - 1, 0)
        place = rank - rank[starts[owner]]
    # Sums of mixed (class, place) pairs tell shapes apart; only the first signs of long odd words count.
    value = np.where(turn & (place >= 0), W.mixed(kind + np.uint64(257) * np.clip(place, 0, 31).astype(np.uint64)), np.uint64(0))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
    return total[ends] - total[starts]


def features(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams present in each text, each once, and where the buckets of each text begin (one more than texts).

    N-grams: one and two words; one to three word shapes, a word that repeats the one before it marked,
    together with the power of two of their share of the text, so that rare and constant use differ.
    """
    data, offsets = W.buffers(text)
    starts, ends, first = W.spans(data, offsets, _NOT_SPACE)
    n = len(starts)
    word = W.hashes(data, starts, ends)
    shape = _shapes(data, starts, ends) if n else word
    again = np.zeros(n, bool)
    again[1:] = word[1:] == word[:-1]
    again[first[:-1][first[:-1] < n]] = False
    shape = W.mixed(shape + np.where(again, _ODD[0], np.uint64(0)))
    sizes = np.diff(first)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    grams, owners, shaped = [], [], []
    for tokens, longest, is_shape in ((word, 2, False), (shape, 3, True)):
        key = tokens
        for k in range(1, longest + 1):
            if k > 1:
                key = key[:-1] * _ODD[1] + tokens[k - 1 :]
            inside = doc[: len(key)] == doc[k - 1 :] if k <= n else np.zeros(0, bool)
            grams.append(W.mixed(key[: len(inside)][inside] + _ODD[2] * np.uint64(2 * k + is_shape)) >> np.uint64(20))
            owners.append(doc[: len(inside)][inside])
            shaped.append(np.full(len(owners[-1]), is_shape))
    gram, owner, is_shape = np.concatenate(grams), np.concatenate(owners), np.concatenate(shaped)
    # One sort by text and gram: the text in the high 20 bits, 43 bits of the gram, one for its kind.
    key = (owner.astype(np.uint64) << np.uint64(44)) | (gram >> np.uint64(1) << np.uint64(1) & np.uint64((1 << 44) - 1)) | is_shape.astype(np.uint64)
    key, count = np.unique(key, return_counts=True)
    owner = (key >> np.uint64(44)).astype(np.int64)
    share = np.where((key & np.uint64(1)).astype(bool), np.floor(np.log2(count / np.maximum(sizes[owner], 1) + 1e-12)).astype(np.int64), 0)
    bucket = W.mixed((key & np.uint64((1 << 44) - 1)) * _ODD[3] + np.clip(share, -8, 0).astype(np.uint64)) % np.uint64(BUCKETS)
    key = np.unique(owner * BUCKETS + bucket.astype(np.int64))
    return (key % BUCKETS).astype(np.int32), np.searchsorted(key, np.arange(len(sizes) + 1) * BUCKETS)


@dataclass
class Model:
    weights: np.ndarray  # of a bucket: log-count ratio times hinge-loss weight
    slope: float
    shift: float

    def margins(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Mean weight by the root of the n-grams present, as in the fit; 0 for a text without words."""
        total = np.concatenate([[0.0], np.cumsum(self.weights[buckets])])
        return (total[first[1:]] - total[first[:-1]]) / np.sqrt(np.maximum(np.diff(first), 1))

    def scores(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(buckets, first) + self.shift, -30, 30)))


def dual_descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, penalty: float = PENALTY, epochs: int = EPOCHS) -> np.ndarray:
    """Hinge-loss weights by dual coordinate descent: one multiplier a row, each set to its best value in turn."""
    w, multipliers = np.zeros(len(ratio)), np.zeros(len(rows))
    values = [ratio[r] / np.sqrt(max(len(r), 1)) for r in rows]
    norms = np.array([v @ v for v in values])
    order = np.random.default_rng(7)
    for _ in range(epochs):
        largest = 0.0
        for i in order.permutation(len(rows)):
            if not norms[i]:
                continue
            r, v = rows[i], values[i]
            gradient = y[i] * (w[r] @ v) - 1
            new = min(max(multipliers[i] - gradient / norms[i], 0.0), penalty)
            change = new - multipliers[i]
            if change:
                w[r] += change * y[i] * v
                multipliers[i] = new
                largest = max(largest, abs(change))
        if largest < 1e-3:
            break
    return w


def _sigmoid(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve from margins to labels, by Newton steps with softened labels."""
    n1, n0 = good.sum(), (~good).sum()
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones_like(margin)], 1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2), x.T @ (target - p) - 1e-4 * at)
        at = at + np.clip(step, -5, 5)
        if abs(step).max() < 1e-6:
            break
    return float(max(at[0], 0.0)), float(at[1])


def fit(rows: list[np.ndarray], good: np.ndarray, ratio: np.ndarray) -> Model:
    """The model from a sample: four fifths of it set the weights, the rest the scale of the scores."""
    if not len(rows) or good.all() or not good.any():
        share = (good.sum() + 1) / (len(rows) + 2)
        return Model(np.zeros(BUCKETS), 0.0, float(np.log(share / (1 - share))))
    tuning = np.arange(len(rows)) % 5 == 4
    if good[tuning].all() or not good[tuning].any() or good[~tuning].all() or not good[~tuning].any():
        tuning[:] = True
        weights = dual_descent(rows, np.where(good, 1.0, -1.0), ratio)
    else:
        weights = dual_descent([r for r, t in zip(rows, tuning) if not t], np.where(good, 1.0, -1.0)[~tuning], ratio)
    model = Model(weights * ratio, 1.0, 0.0)
    some = [r for r, t in zip(rows, tuning) if t]
    first = np.concatenate([[0], np.cumsum([len(r) for r in some])])
    model.slope, model.shift = _sigmoid(model.margins(np.concatenate(some), first), good[tuning])
    return model


def train(labelled: DataFrame, n_labelled: int, fit_rows: int = FIT_ROWS) -> Model:
    """A model from rows (_text, good, pick): class counts over all of them, weights from those whose hash ``pick`` (0 to 1) is
    below fit_rows / n_labelled. One pass; each task hands on one row for each bucket at most, beside its sampled rows."""
    limit = fit_rows / max(n_labelled, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        names, kinds = ["bucket", "n0", "n1", "good", "pick", "buckets"], [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.float64(), pa.list_(pa.int32())]
        for batch in batches:
            for part in slices(batch):
                buckets, first = features(part.column("_text"))
                good, pick = part.column("good").to_numpy(zero_copy_only=False).astype(bool), part.column("pick").to_numpy()
                of = np.repeat(good, np.diff(first))
                for c in (0, 1):
                    counts[c] += np.bincount(buckets[of == bool(c)], minlength=BUCKETS)
                chosen = np.flatnonzero(pick < limit)
                if len(chosen):
                    lists = [buckets[first[i] : first[i + 1]] for i in chosen]
                    none = [None] * len(chosen)
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((none, none, none, good[chosen], pick[chosen], lists), kinds)], names=names)
        seen = np.flatnonzero(counts.sum(axis=0))
        none = [None] * len(seen)
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((seen, counts[0][seen], counts[1][seen], none, none, none), kinds)], names=names)

    made = stored(labelled.mapInArrow(run, "bucket long, n0 long, n1 long, good boolean, pick double, buckets array<int>"))
    sums = made.where("bucket is not null").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()  # at most BUCKETS rows
    counts = np.full((2, BUCKETS), SMOOTHING)
    counts[0, sums["bucket"]] += sums["n0"]
    counts[1, sums["bucket"]] += sums["n1"]
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    ratio[(counts == SMOOTHING).all(axis=0)] = 0.0
    sample = made.where("buckets is not null").select("good", "pick", "buckets").toArrow().sort_by("pick")  # about fit_rows rows
    rows = [np.asarray(r.values) for r in sample.column("buckets")]
    return fit(rows, np.array(sample.column("good").to_pylist(), bool), ratio)


def score_quality(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", learn: str = "pmod(crc32(cast(_id as string)), 5) <> 0",
                  threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS, carry: tuple[str, ...] = ("_text", "_row")) -> DataFrame:
    """Every row of ``docs`` as ``carry`` (see ``tables.packed``) with score (0 to 1, higher: label 1 likelier) and predicted.

    ``labels`` (doc_id, quality 0 or 1) teach where ``learn`` (SQL over _id) holds; other values and null ids teach nothing,
    and an id labelled both ways counts as 0. Scores depend on the text alone. Null and empty texts
    have no n-grams and get the score of margin 0. Without both classes every score is their share.
    Repeated rows are scored one by one, an empty table gives an empty table.
    """
    rows = packed(docs, text)
    known = labels.where("quality in (0, 1)").select(F.col("doc_id").alias("_id"), F.col("quality")).where(F.expr(learn))
    known = stored(known.groupBy("_id").agg((F.min("quality") == 1).alias("good")).where("_id is not null"))
    n = known.count()
    labelled = rows.withColumn("_id", F.col(f"_row.{doc_id}")).select("_id", "_text")
    labelled = labelled.join(F.broadcast(known) if n <= SENT_ROWS else known, "_id")
    pick = (F.xxhash64("_id").bitwiseAND(F.lit((1 << 40) - 1)) / F.lit(float(1 << 40))).alias("pick")
    model = rows.sparkSession.sparkContext.broadcast(train(labelled.select("_text", "good", pick), n, fit_rows))

    def compute(part: pa.RecordBatch) -> list:
        return [model.value.scores(*features(part.column("_text")))]

    scored = each_slice(rows, compute, [T.StructField("score", T.DoubleType())], list(carry))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
