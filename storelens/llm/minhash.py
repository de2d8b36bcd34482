"""Near copies by min-max hashing: both ends of every permutation, banded postings, links confirmed on full shingle sets.

A permutation of the 64-bit shingle hashes gives two signature values, its minimum and its maximum, each equal in two documents with the
probability of their similarity. Bands of four values are postings. Texts with equal sets are one node. Groups of near copies
are contracted first: each node is confirmed against one leader of its buckets. Nodes of buckets that still hold several components then meet by twos of
values, in blocks that carry their sets and only compare across components; a link found there makes two components one at once. So all
components are found, without pairing off the members of one. Every link that is used was confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm.components import components
from storelens.llm.tables import each_slice, packed, slices, stored, task_keys
from storelens.llm.words import buffers, hashes, mixed, spans
from storelens.operators.joins import skew_join

SHINGLE = 3
#: Similarity in per cent from which two sets are linked.
LINK = 85
#: Permutations, two values each; 32 bands of 4 values. A pair at 85 % shares no band with probability 6e-11.
PERMUTATIONS, BAND = 64, 4
VALUES = 2 * PERMUTATIONS
BANDS = VALUES // BAND
#: Equal signature values below which a pair is not confirmed: 5.4 standard deviations under what a pair at 85 % has.
LEAST = 87
#: Twos of minima by which nodes of different components meet: texts that are little alike share single values often, two at once seldom.
TWOS = 18
#: Nodes of a bucket that one tile compares with as many others; sets compared at a time.
BLOCK, _AT_ONCE = 512, 64
#: Bits of the bitmap that says which texts are wanted again (8 MB).
MARKS = 1 << 26
#: Rows that may share a key of a join before it is salted.
_HOT = 50_000

_NOT_SPACE = np.ones(256, bool)
_NOT_SPACE[[*range(0x09, 0x0E), 0x20]] = False
_random = np.random.default_rng(64)
_FACTORS = _random.integers(0, 1 << 63, PERMUTATIONS, np.uint64) << np.uint64(1) | np.uint64(1)
_SHIFTS = _random.integers(0, 1 << 63, PERMUTATIONS, np.uint64)
_PLACES = _random.integers(0, 1 << 63, 8, np.uint64) << np.uint64(1) | np.uint64(1)


# -- sets and signatures ------------------------------------------------------------------------------------------------


def shingle_sets(text: pa.Array) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word shingles; fewer words than a shingle are one together, no words none."""
    data, offsets = buffers(text)
    starts, ends, first = spans(data, offsets, _NOT_SPACE)
    words = hashes(data, starts, ends)
    triples = mixed(words[:-2] * _PLACES[0] + words[1:-1] * _PLACES[1] + words[2:] * _PLACES[2]) if len(words) >= SHINGLE else words[:0]
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(triples[a : b - SHINGLE + 1]))
        else:
            short = [words[a + k : a + k + 1] * _PLACES[3 + k] for k in range(b - a)]
            out.append(mixed(sum(short) + np.uint64(b - a)) if short else words[:0])
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minimum and maximum of every permutation, a row for each set; sets must not be empty."""
    joined, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), VALUES), np.uint64)
    for k in range(PERMUTATIONS):
        moved = (joined + _SHIFTS[k]) * _FACTORS[k]
        out[:, 2 * k] = np.minimum.reduceat(moved, starts)
        out[:, 2 * k + 1] = np.maximum.reduceat(moved, starts)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of a signature."""
    bands = signature.reshape(len(signature), BANDS, BAND)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bands.shape[:2])
    for k in range(BAND):
        key = mixed(key * _PLACES[7] + bands[:, :, k])
    return key


def _described(part: pa.RecordBatch) -> list[pa.Array]:
    sets = shingle_sets(part.column("_text"))
    full = [s for s in sets if len(s)]
    signature = signatures(full) if full else np.empty((0, VALUES), np.uint64)
    keys, row = band_keys(signature), 0
    marks, key_lists, signs = [], [], []
    for s in sets:
        marks.append(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8"))
        key_lists.append(keys[row].view(np.int64) if len(s) else [])
        signs.append(signature[row].astype(np.uint32).tobytes() if len(s) else None)
        row += bool(len(s))
    return [pa.array([len(s) for s in sets], pa.int64()), pa.array([int(m[0]) for m in marks], pa.int64()), pa.array([int(m[1]) for m in marks], pa.int64()),
            pa.array(key_lists, pa.list_(pa.int64())), pa.array(signs, pa.binary())]


_FIELDS = [
    T.StructField("uid", T.LongType()), T.StructField("n_shingles", T.LongType()), T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()),
    T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("signature", T.BinaryType()),
]
_SETS = [T.StructField("shingles", T.BinaryType())]


def _set_bytes(part: pa.RecordBatch) -> list[pa.Array]:
    return [pa.array([s.tobytes() for s in shingle_sets(part.column("_text"))], pa.binary())]


# -- links ----------------------------------------------------------------------------------------------------------------


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share ``percent`` of their union."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs whose full sets are similar. ``sets``: (node, shingles)."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ours, theirs = batch.column("sa").to_pylist(), batch.column("sb").to_pylist()
            keep = [similar(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), percent) for x, y in zip(ours, theirs)]
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], names=["a", "b"])

    return stored(_beside(pairs, sets, "shingles").mapInArrow(check, "a long, b long"))


def _beside(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """(a, b, sa, sb): ``column`` of both nodes of a pair. A node of very many pairs is salted."""
    pairs = stored(pairs)
    left = pairs.join(table.select(F.col("node").alias("a"), F.col(column).alias("sa")), "a")
    right = table.select(F.col("node").alias("b"), F.col(column).alias("sb"))
    return skew_join(left, right, ["b"], "inner", pairs.groupBy("b").agg(F.count("*").alias("n")), _HOT).select("a", "b", "sa", "sb")


def _leaders(postings: DataFrame, turn: int) -> DataFrame:
    """(a, b): for each node the leader it shares most buckets with; a bucket is led by the node that comes first in this turn's order, for nodes outside its component."""
    order = F.struct(F.xxhash64("node", F.lit(turn)), "node", "root")
    leaders = postings.groupBy("key").agg(F.min(order).alias("lead"))
    sizes = postings.groupBy("key").agg(F.count("*").alias("n"))
    met = skew_join(postings, leaders, ["key"], "inner", sizes, _HOT).where(F.col("root") != F.col("lead.root"))
    shared = met.groupBy("node", F.col("lead.node").alias("b")).agg(F.count("*").alias("n"))
    best = F.max(F.struct("n", F.xxhash64("b"), "b"))
    return shared.groupBy(F.col("node").alias("a")).agg(best.alias("best")).select("a", F.col("best.b").alias("b"))


def _agreeing_leaders(pairs: DataFrame, signs: DataFrame, least: int) -> DataFrame:
    """Pairs with enough equal signature values."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ours, theirs = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, VALUES) for c in ("sa", "sb"))
            keep = pa.array((ours == theirs).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])

    return _beside(pairs, signs, "signature").mapInArrow(check, "a long, b long")


_COMPACT = [T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("signs", T.BinaryType()), T.StructField("small", T.BinaryType())]


def _compact(part: pa.RecordBatch) -> list[pa.Array]:
    """What a tile needs of a node: a key for each two of values that is looked up, their hashes and the low bytes of all values, the set in 32 bits."""
    signature = np.frombuffer(b"".join(part.column("signature").to_pylist()), "<u4").reshape(-1, VALUES)
    minima = signature[:, ::2][:, : 2 * TWOS].astype(np.uint64)
    twos = (mixed((minima[:, ::2] << np.uint64(32) | minima[:, 1::2]) * _PLACES[7]) >> np.uint64(32)).astype("<u4")
    keys = twos.astype(np.int64) | np.arange(TWOS, dtype=np.int64) << 32
    low, small = signature.astype(np.uint8), [np.unique(np.frombuffer(x, "<u8") >> np.uint64(32)).astype("<u4").tobytes() for x in part.column("shingles").to_pylist()]
    return [pa.array(list(keys), pa.list_(pa.int64())), pa.array([x.tobytes() + y.tobytes() for x, y in zip(twos, low)], pa.binary()), pa.array(small, pa.binary())]


def _shared(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many values of the sorted set ``own`` each of ``others`` has."""
    joined = np.concatenate(others)
    at = np.minimum(np.searchsorted(own, joined), len(own) - 1)
    return np.add.reduceat((own[at] == joined).astype(np.int64), np.cumsum([0, *map(len, others[:-1])]))


def _tile_links(one: bool, band: int, block: np.ndarray, node: np.ndarray, label: np.ndarray, signs: np.ndarray, sets: list[np.ndarray],
                least: int, percent: int) -> list[tuple[int, int]]:
    """Links of a tile: nodes of block i of a bucket with those of block j, if of different components.

    A pair is looked at in the first bucket that it shares. Nodes that turn out to be linked are one component from there on, so a tile gives fewer links than
    it has components, however many pairs are similar.
    """
    order = np.lexsort((node, block))
    node, label, block, signs, sets = node[order], label[order], block[order], signs[order], [sets[x] for x in order]
    twos, low = signs[:, : 4 * TWOS].copy().view("<u4"), signs[:, 4 * TWOS :]
    sizes, found = np.array([len(x) for x in sets]), []
    for i in range(len(node) if one else int((block == block[0]).sum())):
        other = np.flatnonzero(label != label[i])
        other = other[(other > i) & (one | (block[other] != block[i]))]
        other = other[100 * np.minimum(sizes[other], sizes[i]) >= percent * np.maximum(sizes[other], sizes[i])]
        if not len(other):
            continue
        alike = (low[other] == low[i]).sum(axis=1)
        near = np.flatnonzero((alike >= least) & ~(twos[other, :band] == twos[i, :band]).any(axis=1))
        near = other[near[np.argsort(-alike[near], kind="stable")]]
        for k in range(0, len(near), _AT_ONCE):
            some = near[k : k + _AT_ONCE]
            some = some[label[some] != label[i]]
            if not len(some):
                continue
            both = _shared(sets[i], [sets[x] for x in some])
            some = some[100 * both >= percent * (sizes[i] + sizes[some] - both)]
            for root, first in zip(*np.unique(label[some], return_index=True)):
                found.append((int(node[i]), int(node[some[first]])))
                label[label == root] = label[i]
    return found


_TILE = ["key", "i", "j", "block", "node", "root", "signs", "small"]


def _across(least: int, percent: int):
    """Links of all tiles of a partition that is sorted by them: tiles are small and many, so they are cut out of whole batches."""

    def links_of(part: pa.RecordBatch, edges: list[int]) -> pa.RecordBatch:
        key, i, j, block, node, root = (part.column(c).to_numpy() for c in _TILE[:6])
        signs = np.frombuffer(b"".join(part.column("signs").to_pylist()), np.uint8).reshape(part.num_rows, -1)
        small, found = part.column("small").to_pylist(), []
        for a, b in zip(edges, edges[1:]):
            if (root[a:b] != root[a]).any():
                sets = [np.frombuffer(x, "<u4") for x in small[a:b]]
                found += _tile_links(i[a] == j[a], int(key[a]) >> 32, block[a:b], node[a:b], root[a:b], signs[a:b], sets, least, percent)
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []  # rows of the last tile so far
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = pa.Table.from_batches([*held, batch.select(_TILE)]).combine_chunks().to_batches()[0] if held else batch.select(_TILE)
            key, i, j = (whole.column(c).to_numpy() for c in _TILE[:3])
            edges = [0, *(np.flatnonzero((np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1).tolist()]
            if len(edges) > 1:
                yield links_of(whole.slice(0, edges[-1]), edges)
            held = [whole.slice(edges[-1])]
        if held:
            yield links_of(held[0], [0, held[0].num_rows])

    return run


def _crossing(nodes: DataFrame, least: int, percent: int, block: int = BLOCK) -> DataFrame:
    """(a, b): links that join all components that have a similar pair. ``nodes``: (node, root, keys, signs, small).

    Buckets of two values: a pair at 85 % shares none with probability 9e-11. A bucket's blocks of nodes meet in tiles.
    """
    postings = nodes.select("node", "root", F.explode("keys").alias("key"))
    sizes = postings.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    sizes = stored(sizes.where("low <> high").select("key", "n"))
    cut = sizes.select("key", F.ceil(F.col("n") / F.lit(block)).cast("int").alias("blocks"))
    dealt = skew_join(postings, cut, ["key"], "inner", sizes, _HOT)
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = dealt.withColumn("block", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "root")
    tiles = dealt.join(nodes.select("node", "signs", "small"), "node").select(_TILE)
    tiles = tiles.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return tiles.mapInArrow(_across(least, percent), "a long, b long").distinct()


def links(nodes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int = LINK, least: int = LEAST, block: int = BLOCK, large: int = 8 * BLOCK) -> DataFrame:
    """(node, root) for every node that is linked with another one, over confirmed links.

    ``nodes``: (node, keys, signature) of distinct sets that are not empty. ``sets_of`` gives (node, shingles) for a table of nodes; it is
    asked once, for those that share a bucket with another node. Leaders have one turn, and more while a bucket across components has over ``large`` nodes.
    """
    every = nodes.select("node", F.explode("keys").alias("key"))
    shared = stored(every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    postings = stored(skew_join(every, shared.select("key"), ["key"], "inner", shared, _HOT)).withColumn("root", F.col("node"))
    active = stored(postings.select("node").distinct())
    signs, sets = stored(nodes.select("node", "signature").join(active, "node")), stored(sets_of(active))
    found, turn, grown = confirmed(_agreeing_leaders(_leaders(postings, 0), signs, least), sets, percent), 0, True
    while True:
        roots = stored(components(found))
        known = roots.withColumnRenamed("root", "_root")
        rooted = postings.drop("root").join(known, "node", "left").select("key", "node", F.coalesce("_root", "node").alias("root"))
        open_keys = rooted.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
        open_keys = stored(open_keys.where("low <> high").select("key", "n"))
        largest = open_keys.agg(F.max("n")).first()[0]
        if largest is None:  # every bucket lies in one component
            return roots
        postings = stored(skew_join(rooted, open_keys.select("key"), ["key"], "inner", open_keys, _HOT))
        if largest <= large or not grown:
            break
        turn += 1
        new = confirmed(_agreeing_leaders(_leaders(postings, turn), signs, least), sets, percent)
        found, grown = found.unionByName(new), not new.isEmpty()
    left = postings.select("node", "root").distinct()
    together = signs.join(sets, "node").join(left, "node").select("node", "root", "signature", "shingles")
    tiles = stored(_each_batch(together, _compact, _COMPACT, ["node", "root"]))
    return stored(components(found.unionByName(confirmed(_crossing(tiles, least, percent, block), sets, percent))))


def _each_batch(df: DataFrame, compute: Callable[[pa.RecordBatch], list[pa.Array]], fields: list[T.StructField], keep: list[str]) -> DataFrame:
    schema = T.StructType([*(df.schema[c] for c in keep), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "shingles"):
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *compute(part)], names=schema.names)

    return df.mapInArrow(run, schema)


def _marked(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rows`` whose t1 may be in ``wanted``, so that the texts of the others need not move. A bitmap of hashes says so: MARKS bits whatever the
    size of the tables, put together by Spark from its words. Where very many are wanted it keeps more; the join that follows decides."""
    at = F.pmod(F.col("t1"), F.lit(MARKS))
    words = wanted.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(t1, {MARKS}) % 64 as int))")).alias("bits")).toArrow()
    bitmap = np.zeros(MARKS // 64, np.uint64)
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for batch in batches:
            place = np.mod(batch.column("t1").to_numpy(), MARKS).astype(np.uint64)
            yield batch.filter(pa.array(bitmap[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1) == 1))

    return rows.mapInArrow(keep, rows.schema)


# -- documents ------------------------------------------------------------------------------------------------------------


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = LINK) -> DataFrame:
    """(doc_id, uid, n_shingles, component_id, kept) for every row of ``docs``.

    component_id is the smallest ``doc_id`` that can be reached over links of ``percent`` similarity (shared shingles per hundred of the union), the row's own
    included, or null if no row reached has an id; kept marks rows whose id it is (null counts as equal to null). Null and empty texts and
    texts of white space have no shingles and are linked with nothing, each other included. Equal texts, repeated rows and texts with equal sets
    are linked. Repeated rows each come back. An empty table gives an empty table. Other columns may have any name.
    """
    rows = packed(docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_t")), "_t").select("_text", F.col("_row._id").alias("_id"))
    rows = rows.withColumns({"t1": F.xxhash64("_id", "_text"), "t2": F.xxhash64("_text", "_id", F.lit(2))})  # finds a row again, in any scan
    state: dict = {}
    table = stored(each_slice(rows, lambda part: [task_keys(state, part.num_rows), *_described(part)], _FIELDS, ["_id", "t1", "t2"]))
    full = table.where("n_shingles > 0")
    first = F.min(F.struct(F.col("_id").isNull(), "_id", "uid")).alias("first")
    classes = stored(full.groupBy("h1", "h2").agg(first, F.count("*").alias("n")).withColumn("node", F.col("first.uid")))

    def sets_of(active: DataFrame) -> DataFrame:
        wanted = stored(full.select(F.col("uid").alias("node"), "t1", "t2").join(active, "node"))
        sizes = full.groupBy("t1", "t2").agg(F.count("*").alias("n"))
        texts = skew_join(_marked(rows.select("_text", "t1", "t2"), wanted), wanted, ["t1", "t2"], "inner", sizes, _HOT).select("node", "_text")
        return each_slice(texts.dropDuplicates(["node"]), _set_bytes, _SETS, ["node"])

    roots = links(full.select(F.col("uid").alias("node"), "keys", "signature").join(classes.select("node"), "node"), sets_of, percent)
    tree = stored(classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    least = tree.groupBy("root").agg(F.min("first").alias("least"))
    sizes = tree.groupBy("root").agg(F.count("*").alias("n"))
    of_class = stored(skew_join(tree.select("h1", "h2", "root"), least, ["root"], "inner", sizes).select("h1", "h2", F.col("least._id").alias("component_id")))
    light = table.select("_id", "uid", "n_shingles", "h1", "h2")
    linked = skew_join(light.where("n_shingles > 0"), of_class, ["h1", "h2"], "inner", classes.select("h1", "h2", "n"))
    alone = light.where("n_shingles = 0").withColumn("component_id", F.col("_id"))
    out = linked.select("_id", "uid", "n_shingles", "component_id").unionByName(alone.select("_id", "uid", "n_shingles", "component_id"))
    return out.withColumn("kept", F.col("_id").eqNullSafe(F.col("component_id"))).withColumnRenamed("_id", doc_id)
