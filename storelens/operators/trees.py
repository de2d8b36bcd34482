"""Decision trees on binned features: boosting with penalised leaves, and forests, grown level by level from histograms.

Features are binned once to bytes. At a level, one pass adds up gradient and hessian per (node, feature, bin), and every node takes the split
with the largest gain. Boosting and forests share this step: a forest's gradient is the negative label and its hessian the weight, so
that the gain is the reduction of the Gini impurity. These functions see the rows of one fit inside a task, a byte a feature; ``plans.training``
deals the fits of a search out over the cluster.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bins of a feature; edges are quantiles of its distinct values.
BINS = 64
#: Nodes of a level whose histograms are held at a time.
_NODES_AT_ONCE = 4096


def bin_edges(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Inner edges of each column. A value is in the bin of the first edge that is not below it; all distinct values where they are few."""
    edges = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > bins:
            values = np.unique(np.quantile(column, np.arange(1, bins) / bins, method="lower"))
            values = np.append(values, np.inf)
        edges.append(values[:-1].astype(np.float64))
    return edges


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin numbers, a row for each feature."""
    return np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)]).astype(np.uint8)


def soft(g: np.ndarray, alpha: float) -> np.ndarray:
    """``g`` moved towards zero by ``alpha``: what an absolute penalty leaves of a gradient sum."""
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


@dataclass(frozen=True)
class Limits:
    """What a tree may do. ``depth`` None: no limit. ``child``: least hessian sum of a leaf; ``split``: least rows (weights) of a node that is split."""

    depth: int | None = None
    child: float = 0.0
    split: float = 2.0
    alpha: float = 0.0
    reg: float = 0.0  # squared penalty on leaf values


@dataclass
class Tree:
    """Nodes in level order; a row goes left where its feature's bin is at most ``bin``. Leaves have left -1."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    gain: np.ndarray
    value: np.ndarray
    rows: np.ndarray

    def stops(self, bins: np.ndarray, stops: list[tuple[int | None, float]]) -> np.ndarray:
        """Values of each row in this tree cut back by (depth, split) rules, a row of the result for each rule."""
        n = bins.shape[1]
        at, out = np.zeros(n, np.int64), np.empty((len(stops), n))
        going, depth = np.ones((len(stops), n), bool), 0
        while True:
            leaf = self.left[at] < 0
            for k, (deepest, split) in enumerate(stops):
                end = going[k] & (leaf | (self.rows[at] < split) | (deepest == depth))
                out[k, end] = self.value[at[end]]
                going[k] &= ~end
            if not going.any():
                return out
            goes_right = bins[self.feature[at], np.arange(n)] > self.bin[at]
            at = np.where(leaf, at, self.left[at] + goes_right)
            depth += 1

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.stops(bins, [(None, 0.0)])[0]


def _best_splits(data: np.ndarray, slot: np.ndarray, g: np.ndarray, h: np.ndarray, chosen: np.ndarray, alike: bool, may: np.ndarray, n_bins: int, limits: Limits):
    """Per node the place of its best (feature, bin) among ``chosen``, the gain, and whether it is split. ``alike``: all nodes have the same features."""
    k, width = chosen.shape
    sides = np.empty((2, k, width, n_bins))
    for j in range(width):
        bin_of = data[chosen[0, j]] if alike else data[chosen[slot, j], np.arange(data.shape[1])]
        cell = slot * n_bins + bin_of
        for s, v in enumerate((g, h)):
            sides[s, :, j] = np.bincount(cell, v, k * n_bins).reshape(k, n_bins)
    left = np.cumsum(sides, axis=3)
    whole = left[:, :, :1, -1:]
    gl, hl = left[..., :-1]
    gr, hr = whole[0] - gl, whole[1] - hl

    def strength(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return soft(a, limits.alpha) ** 2 / np.maximum(b + limits.reg, 1e-12)

    gain = strength(gl, hl) + strength(gr, hr) - strength(whole[0], whole[1])
    least = max(limits.child, 1e-9)
    gain = np.where((hl >= least) & (hr >= least) & may[:, None, None], gain, -np.inf).reshape(k, -1)
    best = gain.argmax(axis=1) if gain.shape[1] else np.zeros(k, np.int64)
    top = gain[np.arange(k), best] if gain.shape[1] else np.full(k, -np.inf)
    return best, top, top > 1e-9 * np.maximum(1.0, np.abs(strength(whole[0], whole[1])[:, 0, 0]))


def grow(bins: np.ndarray, g: np.ndarray, h: np.ndarray, limits: Limits, features: np.ndarray, weight: np.ndarray | None = None, leaf_h: np.ndarray | None = None,
         each_node: int | None = None, rng: np.random.Generator | None = None) -> Tree:
    """One tree over the rows with a weight. ``features`` may be used; ``each_node``: so many of them are drawn for every node.

    ``h`` weighs splits, ``leaf_h`` (``h`` if absent) leaf values. Ties go to the first feature and the lowest bin.
    """
    n_bins = int(bins.max(initial=0)) + 1
    weight = np.ones(len(g)) if weight is None else weight
    rows = np.flatnonzero(weight > 0)
    g, h, count = (g * weight)[rows], (h * weight)[rows], weight[rows]
    leaf_h = h if leaf_h is None else (leaf_h * weight)[rows]
    data, slot, nodes, depth, total, first = bins[:, rows], np.zeros(len(rows), np.int64), [], 0, 1, 0
    while True:
        k = total
        sums = [np.bincount(slot, v, k) for v in (g, leaf_h, count)]
        value = -soft(sums[0], limits.alpha) / np.maximum(sums[1] + limits.reg, 1e-12)
        level = {"feature": np.zeros(k, np.int64), "bin": np.zeros(k, np.int64), "left": np.full(k, -1), "gain": np.zeros(k), "value": value, "rows": sums[2]}
        nodes.append(level)
        if len(rows) == 0 or depth == limits.depth:
            break
        may = sums[2] >= limits.split
        if each_node is None:
            chosen = np.broadcast_to(features, (k, len(features)))
        else:
            chosen = np.sort(features[np.argsort(rng.random((k, len(features))), axis=1)[:, :each_node]], axis=1)
        if k > _NODES_AT_ONCE:  # rows of a node side by side, so that a few nodes are a slice of them
            order = np.argsort(slot, kind="stable")
            rows, data, slot, g, h, leaf_h, count = rows[order], data[:, order], slot[order], g[order], h[order], leaf_h[order], count[order]
        best, top, splits = np.zeros(k, np.int64), np.full(k, -np.inf), np.zeros(k, bool)
        for low in range(0, k, _NODES_AT_ONCE):
            some = slice(low, min(k, low + _NODES_AT_ONCE))
            here = slice(0, len(slot)) if k <= _NODES_AT_ONCE else slice(*np.searchsorted(slot, (some.start, some.stop)))
            best[some], top[some], splits[some] = _best_splits(data[:, here], slot[here] - low, g[here], h[here], chosen[some], each_node is None, may[some], n_bins, limits)
        if not splits.any():
            break
        place = np.cumsum(splits) - 1
        f, b = chosen[np.arange(k), best // (n_bins - 1)], best % (n_bins - 1)
        after = first + total
        level["feature"], level["bin"], level["gain"] = np.where(splits, f, 0), np.where(splits, b, 0), np.where(splits, top, 0.0)
        level["left"] = np.where(splits, after + 2 * place, -1)
        stay = splits[slot]
        right = data[f[slot], np.arange(data.shape[1])] > b[slot]
        slot = (2 * place[slot] + right)[stay]
        rows, data = rows[stay], data[:, stay]
        g, h, leaf_h, count = g[stay], h[stay], leaf_h[stay], count[stay]
        first, total, depth = after, 2 * int(splits.sum()), depth + 1
    return Tree(**{name: np.concatenate([level[name] for level in nodes]) for name in nodes[0]})


@dataclass(frozen=True)
class Boosting:
    """Settings of one boosting run. ``newton``: hessians weigh splits too (second order), else rows do and only leaves take Newton steps."""

    trees: int
    depth: int
    rate: float
    subsample: float = 1.0
    columns: float = 1.0
    child: float = 0.0
    alpha: float = 0.0
    reg: float = 0.0
    newton: bool = True


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def boost(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, settings: Boosting, seed: int, watch: np.ndarray | None = None, marks: tuple[int, ...] = ()):
    """Trees, the starting log-odds, and the log-odds of the ``watch`` rows after each of ``marks`` trees.

    Random choices of tree t depend on the seed and t alone, so a run of 100 trees is the beginning of one of 300.
    """
    n, n_features = len(y), len(bins)
    start = 0.0 if settings.newton else float(np.log(max((weight * y).sum(), 1e-9) / max((weight * (1 - y)).sum(), 1e-9)))
    z, seen, staged, trees = np.full(n, start), None if watch is None else np.full(watch.shape[1], start), {}, []
    limits = Limits(settings.depth, settings.child if settings.newton else max(settings.child, 1.0), 2.0, settings.alpha, settings.reg)
    for t in range(settings.trees):
        rng = np.random.default_rng((seed, t))
        p = sigmoid(z)
        taken = weight * (rng.random(n) < settings.subsample) if settings.subsample < 1 else weight
        m = max(1, round(settings.columns * n_features))
        features = np.sort(rng.permutation(n_features)[:m])
        curve = np.maximum(p * (1 - p), 1e-16)
        tree = grow(bins, p - y, curve if settings.newton else np.ones(n), limits, features, taken, curve)
        tree.value = tree.value * settings.rate
        trees.append(tree)
        z += tree.predict(bins)
        if seen is not None:
            seen = seen + tree.predict(watch)
            if t + 1 in marks:
                staged[t + 1] = seen.copy()
    return trees, start, staged


def forest_tree(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, limits: Limits, seed: int, t: int) -> Tree:
    """Tree ``t`` of a forest: rows taken a Poisson number of times, the root of the number of features drawn at every node.

    Rows and features do not depend on how far trees may grow, so cutting a full tree back gives the tree of stricter limits on depth and splits.
    """
    rng = np.random.default_rng((seed, t))
    taken = weight * rng.poisson(1.0, len(y))
    return grow(bins, -y.astype(np.float64), np.ones(len(y)), limits, np.arange(len(bins)), taken, None, max(1, int(np.sqrt(len(bins)))), rng)


def oversampled(x: np.ndarray, y: np.ndarray, scale: np.ndarray, seed: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the smaller class added until both classes are equally large, each on the line from a row to one of its ``k`` nearest of the class.

    Distances are taken after dividing by ``scale``. Rows take turns; neighbour and place are drawn.
    """
    counts = np.bincount(y, minlength=2)
    rare, missing = int(counts.argmin()), int(abs(counts[0] - counts[1]))
    own = x[y == rare]
    if not missing or not len(own):
        return x, y
    scaled, near = own / scale, np.empty((len(own), min(k, max(len(own) - 1, 0))), np.int64)
    norms = (scaled**2).sum(axis=1)
    for a in range(0, len(own), 256):
        part = slice(a, a + 256)
        d = norms[part, None] + norms - 2 * scaled[part] @ scaled.T
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        near[part] = np.argsort(d, axis=1, kind="stable")[:, : near.shape[1]]
    rng = np.random.default_rng((seed, 5))
    base = np.arange(missing) % len(own)
    other = near[base, rng.integers(0, near.shape[1], missing)] if near.shape[1] else base
    made = own[base] + rng.random((missing, 1)) * (own[other] - own[base])
    return np.concatenate([x, made]), np.concatenate([y, np.full(missing, rare)])


def area(y: np.ndarray, score: np.ndarray) -> float:
    """Area under the ROC curve; equal scores count half."""
    values, place = np.unique(score, return_inverse=True)
    neg, pos = np.bincount(place, y == 0, len(values)), np.bincount(place, y == 1, len(values))
    whole = neg.sum() * pos.sum()
    return float((pos * (np.cumsum(neg) - neg / 2)).sum() / whole) if whole else 0.5


def f1(y: np.ndarray, predicted: np.ndarray, of: int = 1) -> float:
    both = ((y == of) & (predicted == of)).sum()
    sides = (y == of).sum() + (predicted == of).sum()
    return float(2 * both / sides) if sides else 0.0


MEASURES = {
    "roc_auc": area,
    "f1": lambda y, p: f1(y, (p >= 0.5).astype(int)),
    "f1_macro": lambda y, p: (f1(y, (p >= 0.5).astype(int)) + f1(y, (p >= 0.5).astype(int), 0)) / 2,
}


#: Rows that walk down the trees at a time, and levels between two looks at which rows still walk.
_WALK_ROWS, _WALK_LEVELS = 4096, 8


class Walker:
    """Trees as flat tables, for scoring many rows: a feature is replaced by the number of the trees' cuts below it, rows walk all levels
    without a branch (a leaf leads to itself), and in deep trees only rows on the way go on."""

    def __init__(self, n_features: int, first: np.ndarray, feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, value: np.ndarray):
        inner = left >= 0
        sizes = np.diff(np.append(first, len(feature)))
        here, root = np.arange(len(feature)), np.repeat(first, sizes)
        self.first, self.value = first, value
        self.column = np.where(inner, feature, 0).astype(np.intp)
        self.child = np.where(inner, root + left, here).astype(np.intp)
        self.cuts = [np.unique(threshold[inner & (feature == f)]) for f in range(n_features)]
        longest = max(map(len, self.cuts), default=0)
        self.kind = next(t for t in (np.uint8, np.uint16, np.uint32) if longest < np.iinfo(t).max)
        self.cut = np.full(len(feature), np.iinfo(self.kind).max, self.kind)  # at a leaf nothing is above it
        for f, cuts in enumerate(self.cuts):
            chosen = inner & (feature == f)
            self.cut[chosen] = np.searchsorted(cuts, threshold[chosen])
        tree, self.depth, going, level = np.repeat(np.arange(len(first)), sizes), np.zeros(len(first), np.int64), first, 0
        while len(going := going[inner[going]]):
            level += 1
            self.depth[tree[going]] = level
            going = np.concatenate([self.child[going], self.child[going] + 1])

    def sums(self, x: np.ndarray) -> np.ndarray:
        """The sum of the values that each row reaches, tree by tree. A missing number goes left."""
        total = np.zeros(len(x))
        for start in range(0, len(x), _WALK_ROWS):
            part = x[start : start + _WALK_ROWS]
            codes = np.empty(part.shape, self.kind)
            for f, cuts in enumerate(self.cuts):
                codes[:, f] = np.where(np.isnan(part[:, f]), 0, np.searchsorted(cuts, part[:, f], side="left"))
            flat, base = codes.ravel(), np.arange(len(part)) * codes.shape[1]
            out = total[start : start + _WALK_ROWS]
            for root, depth in zip(self.first.tolist(), self.depth.tolist()):
                out += self.value.take(self._leaves(flat, base, root, depth))
        return total

    def _down(self, flat: np.ndarray, base: np.ndarray, at: np.ndarray, levels: int) -> np.ndarray:
        for _ in range(levels):
            at = self.child.take(at) + (flat.take(base + self.column.take(at)) > self.cut.take(at))
        return at

    def _leaves(self, flat: np.ndarray, base: np.ndarray, root: int, depth: int) -> np.ndarray:
        at = self._down(flat, base, np.full(len(base), root, np.intp), min(depth, _WALK_LEVELS))
        done, rows = _WALK_LEVELS, None
        while done < depth:
            walking = np.flatnonzero(self.child.take(at) != at) if rows is None else rows[self.child.take(at[rows]) != at[rows]]
            if not len(walking):
                break
            at[walking] = self._down(flat, base[walking], at[walking], min(2, depth - done))
            done, rows = done + 2, walking
        return at
