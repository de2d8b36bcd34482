"""Token sequences of fixed size by shortest-pack-first over the histogram of lengths."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.llm.pieces import REMEMBERED, PieceEncoder, encoder, tokenizer_path
from storelens.llm.tables import packed, slices, stored

CAPACITY = 2048
END_ID = 1
#: Parts that the pieces of one length are numbered in, so that a very common length is no single group.
PARTS = 256
#: Bytes of text whose different units are looked up at once.
LOOKUP_BYTES = 1 << 23
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long"


def pack_histogram(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Patterns ((length, copies), ...) and how many sequences follow each, for ``counts[length]`` pieces.

    Lengths are placed from the longest down, always into the packs filled least so far; packs with one
    pattern are moved together and their count is split when fewer pieces are left. Where no
    open pack has room, new ones take as many copies as fit.
    """
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    least = capacity

    def put(fill: int, pattern: tuple[int, ...], n: int) -> None:
        nonlocal least
        if n:
            open_.setdefault(fill, []).append((pattern, n))
            least = min(least, fill)

    for length in range(capacity, 0, -1):
        left = int(counts[length]) if length < len(counts) else 0
        while left:
            while least < capacity and not open_.get(least):
                least += 1
            if least + length > capacity or not open_.get(least):
                fit = capacity // length
                put(fit * length, (length,) * fit, left // fit)
                put(left % fit * length, (length,) * (left % fit), 1 if left % fit else 0)
                break
            pattern, n = open_[least].pop()
            used = min(left, n)
            fill = least
            put(fill, pattern, n - used)
            put(fill + length, (*pattern, length), used)
            left -= used
    packs = []
    for fill in sorted(open_, reverse=True):
        for pattern, n in open_[fill]:
            runs: list[tuple[int, int]] = []
            for length in pattern:
                runs[-1:] = [(length, runs[-1][1] + 1)] if runs and runs[-1][0] == length else [*runs[-1:], (length, 1)]
            packs.append((tuple(runs), n))
    return packs


def _places(packs: list[tuple[tuple[tuple[int, int], ...], int]]) -> dict[str, np.ndarray]:
    """For each length, in order of rank: from which rank on a pattern takes pieces, and where they go. As many rows as the
    patterns have lengths, which depends on the capacity and not on the number of documents."""
    rows, sequence = [], 0
    for runs, n in packs:
        offset = 0
        for length, copies in runs:
            rows.append((length, copies, n, sequence, offset))
            offset += length * copies
        sequence += n
    rows.sort(key=lambda r: (r[0], r[3], r[4]))
    table = {k: np.array([r[i] for r in rows], np.int64) for i, k in enumerate(("length", "copies", "n", "sequence", "offset"))}
    size = table["copies"] * table["n"]
    before = np.cumsum(size) - size
    first = np.searchsorted(table["length"], table["length"])
    table["rank"] = before - before[first] if len(before) else before
    return table


def encoded(made: PieceEncoder, batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with the ids of their texts in a row and how many each text has. Units of many slices are looked up at once,
    so that common ones are looked up less often."""
    for block in slices(batch, limit=LOOKUP_BYTES):
        numbers, edges = made.unit_numbers_of(block.column("_text"))
        at = 0
        for part in slices(block):
            of = edges[at : at + part.num_rows + 1]
            yield part, *made.ids_of(numbers[of[0] : of[-1]], of - of[0])
            at += part.num_rows


def token_pieces(docs: DataFrame, text: str, doc_id: str, path: str, capacity: int, end_id: int, remembered: int) -> DataFrame:
    """Every document's ids with the end id, cut after each ``capacity`` ids: one row per piece (PIECE)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(path, remembered)
        for batch in batches:
            pa.default_memory_pool().release_unused()  # a worker lives on after its task
            for part, ids, counts in encoded(made, batch):
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id).astype("<u4")
                totals = counts + 1
                ends = np.cumsum(totals)
                pieces = -(-totals // capacity)
                doc = np.repeat(np.arange(len(totals)), pieces)
                number = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = number * capacity
                length = np.minimum(totals[doc] - start, capacity)
                at = ends[doc] - totals[doc] + start
                crc = [zlib.crc32(ids[a : a + n]) for a, n in zip(at.tolist(), length.tolist())]
                owner = part.column("_id").take(pa.array(doc))
                columns = [owner, *(pa.array(x, pa.int64()) for x in (start, length, crc, totals[doc], np.array(crc, np.int64) % PARTS))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part"])

    rows = packed(docs, text).select("_text", F.col(f"_row.{doc_id}").cast("long").alias("_id"))
    return rows.mapInArrow(run, PIECE)


def _salted(pieces: DataFrame) -> DataFrame:
    """Equal pieces (empty texts, copies) are spread over the parts by document."""
    return pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(PARTS)))


def pack(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         remembered: int = REMEMBERED) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_size) for every piece of every document.

    Documents are cut after each ``capacity`` ids; a sequence holds whole pieces without gaps from offset 0.
    sequence_size is the ids it holds where that is a power of two, else ``capacity`` (the rest is padding).
    Null and empty texts are the end id alone. A null doc_id stays null. Repeated rows are packed one by
    one. An empty table gives an empty table. ``remembered`` pieces stay in a worker's memory: fewer take more time.
    Only the histogram (one count per length) reaches the driver.
    """
    path = tokenizer or tokenizer_path()
    pieces = stored(_salted(token_pieces(docs, text, doc_id, path, capacity, end_id, remembered)))
    by_part = stored(pieces.groupBy("length", "part").agg(F.count("*").alias("n")))
    counts = np.zeros(capacity + 1, np.int64)
    for row in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[row["length"]] = row["n"]
    packs = pack_histogram(counts, capacity)
    table = _places(packs)
    base, size = table["length"] << 40, np.array([sum(k * c for k, c in runs) for runs, _ in packs], np.int64)
    firsts = np.cumsum([0, *(n for _, n in packs)])[:-1] if packs else np.zeros(0, np.int64)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = base + table["rank"]
        for b in batches:
            length, rank = b["length"].to_numpy(), b.pop("rank").to_numpy()
            row = np.searchsorted(keys, (length << 40) + rank, "right") - 1
            nth = rank - table["rank"][row]
            b["sequence_id"] = table["sequence"][row] + nth // table["copies"][row]
            b["offset"] = table["offset"][row] + nth % table["copies"][row] * length
            held = size[np.searchsorted(firsts, b["sequence_id"].to_numpy(), "right") - 1]
            b["sequence_size"] = np.where(held & (held - 1) == 0, held, capacity)
            b["doc_id"] = b["doc_id"].astype("Int64")
            yield b

    earlier = by_part.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).drop("n")
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32"))
    ranked = pieces.withColumn("k", within).join(earlier, ["length", "part"])
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("k") - 1).alias("rank"))
    return ranked.mapInPandas(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_size long")
