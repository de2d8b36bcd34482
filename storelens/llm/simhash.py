"""Near copies by SimHash: byte-position postings, count filtering, verification, components."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm.components import components
from storelens.llm.tables import each_slice, packed, stored, task_keys, unpacked
from storelens.llm.words import lowered

SHINGLE = 3
SEED = 42
#: Differing bits that still link two fingerprints; so many of the 8 bytes agree at least.
MAX_BITS = 3
MIN_BYTES = 8 - MAX_BITS
#: Fingerprints that one group of postings may hold before its key is refined.
GROUP = 4096
_CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash over the XXH64 of word shingles, repeats included. No words: zero. Fewer words than a shingle: all of them."""
    words = lowered(text).split()  # splits at \\t to \\r and space, as the word pattern does
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(itertools.accumulate((len(w) + 1 for w in words), initial=-1))[1:]
    starts = [0, *(e + 1 for e in ends[: len(words) - shingle])]
    digest, votes, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(starts)
    for k in range(0, n, _CHUNK):  # a very long text goes through in parts
        pairs = zip(starts[k : k + _CHUNK], ends[k + shingle - 1 : k + shingle - 1 + _CHUNK])
        part = np.array([digest(joined[a:b], SEED) for a, b in pairs], "<u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def _fingerprints(part: pa.RecordBatch) -> list:
    values = [fingerprint(t) for t in part.column("_text").to_pylist()]
    return [np.array(values, np.uint64).view(np.int64)]


# Masks: which bits of a fingerprint a posting's key fixes. Signed, as Spark's longs are.
def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _bytes_mask(places: tuple[int, ...]) -> int:
    return sum(0xFF << (8 * p) for p in places)


#: A pair that agrees in 5 of 8 bytes has three agreeing bytes in one half: these eight triples miss no pair.
TRIPLES = [_bytes_mask(half[:k] + half[k + 1 :]) for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for k in range(4)]


def refinements(mask: int) -> list[int]:
    """Longer keys such that every linked pair that shares ``mask`` shares one of them.

    Three bytes fixed: two of the other five agree, so one of any four of them does. Four bytes fixed:
    one of the other four agrees. Beyond that at most 3 of the free bits differ, so one of
    four groups of them agrees. At under 16 free bits a group is small enough as it is.
    """
    free = [p for p in range(8) if not (mask >> (8 * p)) & 0xFF]
    bits = [b for b in range(64) if not (mask >> b) & 1]
    if len(bits) < 16:
        return []
    if len(free) >= 4 and len(bits) == 8 * len(free):
        return [mask | _bytes_mask((p,)) for p in free[:4]]
    return [mask | sum(1 << b for b in bits[k::4]) for k in range(4)]


def _linked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct fingerprints: each one and the root of its tree.

    Two are tallied over the eight byte positions; pairs with MIN_BYTES equal bytes are verified bit by bit.
    """
    left, nodes, roots = np.sort(values), [], []
    while len(left) > 1:
        root, frontier = left[0], [left[0]]
        left = left[1:]
        while frontier and len(left):
            apart = left ^ frontier.pop()
            same = (apart.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            near = np.flatnonzero(same >= MIN_BYTES)
            near = near[np.bitwise_count(apart[near]) <= MAX_BITS]
            if len(near):
                nodes.append(left[near])
                roots.append(np.full(len(near), root))
                frontier.extend(left[near])
                keep = np.ones(len(left), bool)
                keep[near] = False
                left = left[keep]
    empty = np.zeros(0, np.uint64)
    return (np.concatenate(nodes), np.concatenate(roots)) if nodes else (empty, empty)


def _links_of_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for group in batch["fps"]:
            nodes, roots = _linked(np.asarray(group, np.int64).view(np.uint64))
            if len(nodes):
                yield pd.DataFrame({"a": nodes.view(np.int64), "b": roots.view(np.int64)})


def _refined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[int, list[int]] = {}
    for batch in batches:
        for mask, rows in batch.groupby("mask"):
            fps = rows["fp"].to_numpy()
            for longer in known.setdefault(mask, refinements(mask & (2**64 - 1))):
                longer = _signed(longer)
                yield pd.DataFrame({"mask": longer, "key": fps & np.int64(longer), "fp": fps})


def links(fps: DataFrame, group: int = GROUP) -> DataFrame:
    """(a, b): links between different fingerprints that join the same components as all links within MAX_BITS do.

    ``fps`` has distinct longs in column fp. Keys are counted first. Groups up to ``group`` are compared in one
    piece and give a spanning forest, not all pairs; larger ones are dealt out again under longer keys until they are small.
    """
    masks = F.array(*[F.lit(_signed(m)).cast("long") for m in TRIPLES])
    postings = fps.select("fp", F.explode(masks).alias("mask")).select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
    found = None
    while postings is not None:
        counts = stored(postings.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1"))
        last = F.lit(64) - F.bit_count("mask") < 16
        small = postings.join(counts.where((F.col("n") <= group) | last).drop("n"), ["mask", "key"])
        small = small.groupBy("mask", "key").agg(F.collect_list("fp").alias("fps")).select("fps")
        part = small.mapInPandas(_links_of_groups, "a long, b long")
        found = part if found is None else found.union(part)
        large = counts.where((F.col("n") > group) & ~last).drop("n")
        if large.isEmpty():
            break
        postings = stored(postings.join(large, ["mask", "key"]).mapInPandas(_refined, "mask long, key long, fp long").distinct())
    return found


def _groups(docs: DataFrame, doc_id: str, text: str, carry: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Documents with uid and fingerprint, and (fp, component_id, first_uid) of every fingerprint."""
    rows = packed(docs, text).withColumn("_id", F.col(f"_row.{doc_id}"))
    state: dict = {}
    fields = [T.StructField("uid", T.LongType()), T.StructField("fp", T.LongType())]
    table = stored(each_slice(rows, lambda part: [task_keys(state, part.num_rows), *_fingerprints(part)], fields, [*carry, "_id"]))
    first = F.min(F.struct(F.col("_id").isNull(), "_id", "uid")).alias("first")
    classes = stored(table.groupBy("fp").agg(first))
    roots = components(links(classes.select("fp")))
    tree = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    tree = stored(tree)
    least = tree.groupBy("root").agg(F.min("first").alias("first"))
    of_class = tree.select("fp", "root").join(least, "root").select("fp", F.col("first._id").alias("component_id"), F.col("first.uid").alias("first_uid"))
    return table, of_class


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ("_text", "_row")) -> DataFrame:
    """Every row of ``docs`` as ``carry`` (see ``tables.packed``) with uid, fp (long), component_id and first_uid.

    component_id is the smallest ``doc_id`` whose fingerprint can be reached over links of at most MAX_BITS
    differing bits, the row's own included (null if no row of the component has an id);
    first_uid marks one row of the component that has this id. Equal fingerprints are one
    node. Null, empty and white texts have fingerprint zero and are linked like any other.
    Repeated rows each come back. An empty table gives an empty table.
    """
    table, of_class = _groups(docs, doc_id, text, carry)
    return table.join(of_class, "fp").select(*carry, "_id", "uid", "fp", "component_id", "first_uid")


def distinct_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row of each component of near copies (the one with the smallest doc_id), all columns as they were."""
    table, of_class = _groups(docs, "doc_id", text, ("_text", "_row"))
    copies = stored(table.select("uid", "fp").join(of_class, "fp").where("uid <> first_uid").select("uid"))  # texts need not move to lose them
    return unpacked(table.join(copies, "uid", "left_anti"), docs.columns, text)
