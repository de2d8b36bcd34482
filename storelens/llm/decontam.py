"""Benchmark passages in documents, found through a distributed positional inverted index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm import words as W
from storelens.llm.tables import each_slice, packed, slices, stored, task_keys, unpacked

#: Consecutive words that make a window, and how many of them must stand in place for a proximity match.
WINDOW = 10
NEAR = 8
#: Words by which those of a proximity match may be moved against each other by insertions and deletions, in items of at least NEAR words.
SHIFT = 2
#: Words of benchmark items looked up in one pass over the documents. The items are a query set, taken in blocks of this size.
BLOCK_WORDS = 2_000_000
#: Columns added to each document.
RESULT = ["n_words", "n_hit", "n_items", "n_near", "items_sha256", "contaminated"]


def item_words(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_no, item_id, pos, term, n): every word of every item. Items without words have no rows; a null id is the empty string."""
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"), F.col(text).cast("string").alias("_text"))
    rows = stored(rows.withColumn("item_no", F.monotonically_increasing_id()))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    terms = F.regexp_extract_all(F.translate("_text", upper, lower), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))
    listed = rows.select("item_no", "item_id", terms.alias("terms"))
    return listed.select("item_no", "item_id", F.size("terms").alias("n"), F.posexplode("terms").alias("pos", "term"))


class Vocabulary:
    """Terms of one block of items as sorted hashes; the place of a term is its number. At most BLOCK_WORDS terms."""

    def __init__(self, terms: list[str]):
        raw = pa.array(terms, pa.string())
        data, offsets = W.buffers(raw)
        keys = W.hashes(data, offsets[:-1], offsets[1:]) if terms else np.zeros(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.terms = [terms[i].encode("utf-8", "surrogatepass") for i in order]
        # Two terms with one hash are told apart by their bytes; their places are neighbours.
        self.twins = bool((self.keys[1:] == self.keys[:-1]).any()) if len(terms) > 1 else False

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """Number of the term for each hash, -1 where there is none."""
        if not len(self.keys):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)

    def exact(self, number: int, word: bytes) -> int:
        """The term that equals ``word``, -1 if only the hash agrees."""
        while number < len(self.keys):
            if self.terms[number] == word:
                return number
            if not self.twins or number + 1 == len(self.keys) or self.keys[number + 1] != self.keys[number]:
                return -1
            number += 1
        return -1


def _frequencies(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(term_no, freq): how often each term of the block stands in all documents. One count per term leaves each task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary.keys), np.int64)
        for batch in batches:
            for part in slices(batch):
                data, offsets = W.buffers(part.column("_text"))
                starts, ends, _ = W.spans(data, offsets)
                found = vocabulary.look_up(W.hashes(data, starts, ends))
                total += np.bincount(found[found >= 0], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["term_no", "freq"])

    return docs.select("_text").mapInArrow(count, "term_no long, freq long").groupBy("term_no").agg(F.sum("freq").alias("freq"))


def _anchors(terms: DataFrame, window: int, near: int) -> DataFrame:
    """(item_no, pos, gap, first, second): pairs of words of an item, ``gap`` words apart, of which every match holds one.

    Of the words of a window that occur in the documents, a match lacks at most as many as there are beyond those needed, so it
    holds two of that many plus two, taken from the rarest on. A window without enough words that occur has no match. One-word items pair with themselves.
    """
    listed = terms.groupBy("item_no", "n").agg(F.sort_array(F.collect_list(F.struct("pos", "freq", "term_no"))).alias("ws"))
    rare = F.transform("ws", lambda w: F.struct(w["freq"].alias("freq"), w["pos"].alias("pos"), w["term_no"].alias("term_no")))
    needed = F.least(F.lit(near), F.col("n"))
    windows = listed.select("item_no", "n", needed.alias("needed"), rare.alias("rare")).select("item_no", "needed", F.explode(
        F.transform(F.sequence(F.lit(1), F.greatest(F.col("n") - F.lit(window - 1), F.lit(1))), lambda k: F.array_sort(F.filter(F.slice("rare", k, window), lambda w: w["freq"] > 0)))).alias("ws"))
    chosen = windows.where(F.size("ws") >= F.col("needed")).select("item_no", F.slice("ws", F.lit(1), F.size("ws") - F.col("needed") + 2).alias("ws")).distinct()
    one = chosen.withColumn("a", F.explode("ws"))
    pairs = one.withColumn("b", F.explode("ws")).where((F.col("b.pos") > F.col("a.pos")) | (F.size("ws") == 1))
    gap = (F.col("b.pos") - F.col("a.pos")).alias("gap")
    return pairs.select("item_no", F.col("a.pos").alias("pos"), gap, F.col("a.term_no").alias("first"), F.col("b.term_no").alias("second")).distinct()


def _moved(n: str, near: int, shift: int) -> Column:
    """How far words of an item of ``n`` words may be moved."""
    return F.when(F.col(n) >= near, shift).otherwise(0)


class Pairs:
    """Pairs of terms of one block's anchors as sorted codes, with a bit for every distance at which they may stand in a document."""

    def __init__(self, anchors: DataFrame, terms: int):
        rows = anchors.select("first", "second", "gap", "moved").distinct().toArrow()  # of one block
        first, second, gap, moved = (rows.column(c).to_numpy().astype(np.int64) for c in ("first", "second", "gap", "moved"))
        self.terms, self.codes = terms, np.unique(first * terms + second)
        self.bits = np.zeros(len(self.codes), np.int64)
        at = np.searchsorted(self.codes, first * terms + second)
        for m in range(-int(moved.max(initial=0)), int(moved.max(initial=0)) + 1):
            fits = (abs(m) <= moved) & ((gap + m > 0) | (m == 0))
            np.bitwise_or.at(self.bits, at[fits], np.int64(1) << (gap + m)[fits])
        self.reach = int((gap + moved).max(initial=0))
        self.starts, self.ends = np.zeros(terms + 1, bool), np.zeros(terms + 1, bool)  # the last place is for words that are no terms
        self.starts[first] = self.ends[second] = True

    def hits(self, found: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first word of each pair, and its distance to the second, in order of places; ``first``: the first word of each text."""
        starts = np.flatnonzero(self.starts[found])
        stop = first[np.searchsorted(first, starts, "right")] if len(starts) else starts
        places, gaps = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for gap in range(self.reach + 1):
            q = starts[starts + gap < stop]
            q = q[self.ends[found[q + gap]]]
            code = found[q] * self.terms + found[q + gap]
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            q = q[(self.codes[at] == code) & (self.bits[at] >> gap & 1 == 1)]
            places.append(q)
            gaps.append(np.full(len(q), gap))
        places, gaps = np.concatenate(places), np.concatenate(gaps)
        order = np.argsort(places, kind="stable")
        return places[order], gaps[order]


def _index(docs: DataFrame, vocabulary: Vocabulary, pairs: Pairs, window: int, shift: int, keep: list[str]) -> DataFrame:
    """The positional index by document: n_words, the pairs (codes, gaps, firsts) that stand in it, and the postings (terms, places) that can be part of a match.

    A match holds at least one pair, so a posting more than ``window`` - 1 + 2 * ``shift`` words away from
    every pair of its document is never asked for and is not stored.
    """
    names = {"terms": T.IntegerType(), "places": T.IntegerType(), "codes": T.LongType(), "gaps": T.IntegerType(), "firsts": T.IntegerType()}
    fields = [T.StructField("uid", T.LongType()), T.StructField("n_words", T.LongType()), *(T.StructField(k, T.ArrayType(t)) for k, t in names.items())]
    state: dict = {}
    reach = window - 1 + 2 * shift

    def compute(part: pa.RecordBatch) -> list:
        data, offsets = W.buffers(part.column("_text"))
        starts, ends, first = W.spans(data, offsets)
        found = vocabulary.look_up(W.hashes(data, starts, ends))
        edge = np.zeros(len(starts) + 1, np.int64)
        hit, gap = pairs.hits(found, first)
        doc = np.searchsorted(first, hit, "right") - 1
        np.add.at(edge, np.maximum(hit - reach, first[doc]), 1)
        np.add.at(edge, np.minimum(hit + reach + 1, first[doc + 1]), -1)
        near = np.flatnonzero((np.cumsum(edge[:-1]) > 0) & (found >= 0))
        raw = data.tobytes() if len(near) else b""
        terms = np.array([vocabulary.exact(int(found[i]), raw[starts[i] : ends[i]].lower()) for i in near], np.int32)
        near, terms = near[terms >= 0], terms[terms >= 0]
        owner = np.searchsorted(first, near, "right") - 1
        bounds, pair_bounds = np.searchsorted(near, first).astype(np.int32), np.searchsorted(hit, first).astype(np.int32)

        def lists(bounds: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
            return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values, kind))

        return [
            task_keys(state, part.num_rows), np.diff(first),
            lists(bounds, terms, pa.int32()), lists(bounds, (near - first[owner]).astype(np.int32), pa.int32()),
            lists(pair_bounds, found[hit] * pairs.terms + found[hit + gap], pa.int64()), lists(pair_bounds, gap.astype(np.int32), pa.int32()),
            lists(pair_bounds, (hit - first[doc]).astype(np.int32), pa.int32()),
        ]

    return each_slice(docs, compute, fields, keep)


def in_order(points: list[tuple[int, int]], size: int, needed: int, shift: int) -> bool:
    """Whether ``needed`` words of a window of ``size`` item places stand in order, moved against each other by ``shift`` words at most.
    ``points``: place in the item and by how much the word is moved."""
    for low in range(min(m for _, m in points), max(m for _, m in points) + 1):
        band = sorted((p, p + m) for p, m in points if low <= m <= low + shift)
        for k, (begin, _) in enumerate(band):
            if k and band[k - 1][0] == begin:
                continue
            inside = [x for x in band[k : k + size * (shift + 1)] if x[0] < begin + size]
            longest: list[int] = []
            for i, (p, q) in enumerate(inside):
                longest.append(1 + max((longest[j] for j in range(i) if inside[j][0] < p and inside[j][1] < q), default=0))
            if max(longest) >= needed:
                return True
    return False


def _close(groups: DataFrame) -> DataFrame:
    """(uid, item_id) of the groups (uid, item_id, size, needed, moved, points) whose points are in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("points", "size", "needed", "moved")))
            kept = [in_order([(x["item_pos"], x["m"]) for x in points], *rest) for points, *rest in rows]
            yield batch.select(["uid", "item_id"]).filter(pa.array(kept, pa.bool_()))

    return groups.mapInArrow(run, "uid long, item_id string")


def _matches(index: DataFrame, terms: DataFrame, anchors: DataFrame, total: int, window: int, near: int) -> tuple[DataFrame, DataFrame]:
    """Words of documents in place for an item: (uid, item_no, item_id, pos) of exact windows, and (uid, item_id) of proximity matches."""
    some = index.where(F.size("terms") > 0)
    postings = some.select("uid", F.explode(F.arrays_zip("terms", "places")).alias("p"))
    postings = postings.select("uid", F.col("p.terms").cast("long").alias("term_no"), F.col("p.places").cast("long").alias("pos"))
    placed = terms.select("item_no", "item_id", "n", "term_no", F.col("pos").cast("long").alias("item_pos"))
    hits = some.select("uid", F.explode(F.arrays_zip("codes", "gaps", "firsts")).alias("h")).select("uid", F.col("h.codes").alias("code"), F.col("h.gaps").alias("stands"), F.col("h.firsts").cast("long").alias("at"))
    coded = anchors.select("item_no", F.col("pos").alias("anchor_pos"), "gap", "moved", (F.col("first") * F.lit(total) + F.col("second")).alias("code"))
    # Where a pair stands, the item would have to start at `start`, up to `moved` words.
    found = hits.join(coded, "code").where(F.abs(F.col("stands") - F.col("gap")) <= F.col("moved"))
    found = found.select("uid", "item_no", "anchor_pos", "moved", (F.col("at") - F.col("anchor_pos")).alias("start")).distinct()
    reach = placed.join(anchors.select("item_no", F.col("pos").alias("anchor_pos")).distinct(), "item_no").where(F.abs(F.col("item_pos") - F.col("anchor_pos")) < window)
    wanted = found.join(reach, ["item_no", "anchor_pos"]).select("uid", "item_no", "item_id", "n", "moved", "start", "term_no", "item_pos").distinct()
    wanted = wanted.withColumn("m", F.explode(F.sequence(-F.col("moved"), F.col("moved")))).withColumn("pos", F.col("start") + F.col("item_pos") + F.col("m"))
    met = wanted.join(postings, ["uid", "pos", "term_no"])
    by_start = met.groupBy("uid", "item_no", "item_id", "n", "moved", "start").agg(
        F.sort_array(F.collect_list(F.when(F.col("m") == 0, F.col("item_pos")))).alias("at"), F.collect_list(F.struct("item_pos", "m")).alias("points"), F.size(F.collect_set("item_pos")).alias("places"))
    size = F.least(F.lit(window), F.col("n"))
    # A place begins a whole window if the place `size` - 1 further down the sorted list is `size` - 1 words on.
    begins = F.filter(F.sequence(F.lit(1), F.size("at") - size + 1), lambda k: F.element_at("at", (k + size - 1).cast("int")) - F.element_at("at", k.cast("int")) == size - 1)
    enough = by_start.where(F.size("at") >= size).select("uid", "item_no", "item_id", "start", size.alias("size"), F.transform(begins, lambda k: F.element_at("at", k.cast("int"))).alias("begins"))
    covered = F.array_distinct(F.flatten(F.transform("begins", lambda b: F.sequence(b, b + F.col("size") - 1))))
    exact = enough.where(F.size("begins") > 0).select("uid", "item_no", "item_id", F.explode(covered).alias("item_pos"), "start")
    exact = exact.select("uid", "item_no", "item_id", (F.col("start") + F.col("item_pos")).alias("pos"))
    needed = F.least(F.lit(near), F.col("n"))
    close = _close(by_start.where(F.col("places") >= needed).select("uid", "item_id", size.alias("size"), needed.alias("needed"), "moved", "points"))
    return exact, close


def _blocks(spark: SparkSession, terms: DataFrame) -> list[DataFrame]:
    total = terms.count()
    n = -(-total // BLOCK_WORDS)
    return [terms] if n <= 1 else [terms.where(F.pmod(F.hash("item_no"), F.lit(n)) == k) for k in range(n)]


def _search(docs: DataFrame, items: DataFrame, text: str, item_id: str, item_text: str, window: int, near: int, carry: tuple[str, ...]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The index with ``carry``, the words of exact matches, and the proximity matches, over all blocks of items."""
    spark = docs.sparkSession
    terms = stored(item_words(items, item_id, item_text))
    rows, parts = packed(docs, text), []
    index = None
    for block in _blocks(spark, terms):
        listed = [r.term for r in block.select("term").distinct().collect()]  # at most BLOCK_WORDS
        vocabulary = Vocabulary(listed)
        numbers = spark.createDataFrame([(i, t.decode("utf-8", "surrogatepass")) for i, t in enumerate(vocabulary.terms)], "term_no long, term string")
        freq = _frequencies(rows, vocabulary)
        block = stored(block.join(numbers, "term").join(freq, "term_no", "left").fillna(0, ["freq"]))
        shift = SHIFT if near < window else 0
        moved = block.select("item_no", _moved("n", near, shift).alias("moved")).distinct()
        anchors = stored(_anchors(block, window, near).join(moved, "item_no"))
        pairs = Pairs(anchors, len(vocabulary.keys))
        this = stored(_index(rows, vocabulary, pairs, window, shift, list(carry) if index is None else []))
        parts.append(_matches(this, block, anchors, len(vocabulary.keys), window, near))
        index = this if index is None else index
    return index, stored(_union([e for e, _ in parts])), _union([c for _, c in parts])


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, near: int = NEAR,
                  carry: tuple[str, ...] = ("_text", "_row")) -> tuple[DataFrame, DataFrame]:
    """(documents, matches): every row of ``docs`` as ``carry`` (``_text``, ``_row``, see ``tables.packed``) with the columns RESULT, and
    (uid, item_no, item_id, pos) of every word inside an exact match.

    A window is ``window`` consecutive words of an item, or the whole of a shorter item. n_hit counts the
    words of a document inside any occurrence of a window, n_items the distinct item ids found;
    n_near those with ``near`` of the words of a window (all of an item with fewer) in order and moved against each other by
    SHIFT words at most, where an item has ``near`` words or more, else in place (proximity; exact matches included).
    Null and empty texts have no words and no hits. Items without words match nothing. Repeated
    rows of documents are judged one by one; repeated items count once by id. With no items or no
    documents nothing is hit. Texts are whole; no list of postings or candidates is cut.
    """
    index, exact, close = _search(docs, items, text, item_id, item_text, window, near, carry)
    words_hit = exact.select("uid", "pos").distinct().groupBy("uid").agg(F.count("*").alias("n_hit"))
    ids = exact.select("uid", "item_id").distinct().groupBy("uid").agg(F.sort_array(F.collect_list("item_id")).alias("ids"))
    loose = close.distinct().groupBy("uid").agg(F.count("*").alias("n_near"))
    found = words_hit.join(ids, "uid").join(loose, "uid", "full")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    none = F.lit(0).cast("long")
    out = index.join(found, "uid", "left").select("uid", *carry, "n_words", F.coalesce("n_hit", none).alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
                                                  F.coalesce("n_near", none).alias("n_near"), F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"))
    return out.withColumn("contaminated", F.col("n_hit") > 0), exact


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def clean_documents(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no window of any item, all columns as they were."""
    index, exact, _ = _search(docs, items, text, "item_id", "text", WINDOW, WINDOW, ("_text", "_row"))  # exact matches only
    hit = stored(exact.select("uid").distinct())  # few rows against the documents, whose texts need not move to lose them
    return unpacked(index.join(hit, "uid", "left_anti"), docs.columns, text)
