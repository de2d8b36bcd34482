"""Language of a text by interpolated Kneser-Ney models over characters, one per language."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm.tables import each_slice, packed, slices, stored, unpacked

#: A symbol is a lower-case letter or mark by its own 16-bit code point, and 0 for all else. Letters beyond 16 bits (rare and historic
#: scripts) are hashed to the private code points, which no letter has. So a gram of four symbols is a 64-bit number that tells all
#: grams apart, its first three symbols (context) and its last three (shorter gram) are shifts and masks.
BITS = 16
ORDER = 4
UNKNOWN = "und"
#: A text is foreign to its language if its surprise above the mean, times the root of its symbols (STEADY at most: longer texts do not
#: get steadier, as they hold passages of other kinds), exceeds SLACK times what all but REJECTED of the calibration rows have, and one nat at STEADY.
REJECTED = 1e-4
SLACK = 2.0
STEADY = 50
#: One in so many learned rows is left out of the counts; margins, means and limits are measured on these.
CALIBRATION = 10
_BINS = 64
#: Grams looked up, and grams held while counting, at a time: both bound a worker's memory, not what is scored or counted.
_AT_ONCE, _HELD = 1 << 17, 500_000
_PRIVATE, _N_PRIVATE = 0xE000, 0x1900


def _symbol_table() -> np.ndarray:
    table = np.zeros(0x10000, np.uint16)
    for cp in range(0x10000):
        c = chr(cp)
        if unicodedata.category(c)[0] in "LM":
            low = ord(c.lower()[0])
            table[cp] = low if low < 0x10000 else cp
    return table


_symbols: list[np.ndarray] = []


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts in a row, runs of non-letters as one 0, each text led by ORDER - 1 zeros; first place of each text."""
    if not _symbols:
        _symbols.append(_symbol_table())
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _symbols[0][points & 0xFFFF]
    for at in np.flatnonzero(points >= 0x10000):
        c = chr(points[at])
        codes[at] = _PRIVATE + ord(c.lower()[0]) % _N_PRIVATE if unicodedata.category(c)[0] in "LM" else 0
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    again = np.zeros(len(codes), bool)
    again[1:] = (codes[1:] == 0) & (codes[:-1] == 0)
    again[(ends - lengths)[lengths > 0]] = False
    kept = np.flatnonzero(~again)
    first = np.searchsorted(kept, np.concatenate([[0], ends]))
    sizes = np.diff(first)
    pad = ORDER - 1
    out = np.zeros(len(kept) + pad * len(texts), np.uint64)
    out[np.arange(len(kept)) + np.repeat(pad * np.arange(1, len(texts) + 1), sizes)] = codes[kept]
    return out, first + pad * np.arange(len(texts) + 1)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The gram that ends at each symbol of each text, and the number of the first gram of each text (one more than texts)."""
    s, first = symbols(texts)
    pad = ORDER - 1
    if len(s) < ORDER:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    key = s[: len(s) - pad].copy()
    for k in range(1, ORDER):
        key <<= np.uint64(BITS)
        key |= s[k : len(s) - pad + k]
    real = np.ones(len(key) + pad, bool)
    for k in range(pad):  # grams that end on the lead of a text belong to none
        real[first[:-1] + k] = False
    return key[real[pad:]], first - pad * np.arange(len(first))


def _context(keys: np.ndarray) -> np.ndarray:
    return keys >> np.uint64(BITS)


def _shorter(keys: np.ndarray, order: int) -> np.ndarray:
    return keys & np.uint64((1 << (BITS * (order - 1))) - 1)


def _places(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in the sorted ``table``, -1 where it is not there."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


@dataclass
class Level:
    """Grams of one order and their contexts, each a sorted array over all languages, with a column for each language."""

    keys: np.ndarray
    seen: np.ndarray  # (keys, languages): log probability
    contexts: np.ndarray
    left: np.ndarray  # (contexts, languages): log weight left to shorter grams; 0 where a language has not met the context


@dataclass
class Model:
    """Kneser-Ney levels from single symbols to whole grams. Its size is that of the grams met: 4 bytes a gram and language."""

    languages: list[str]
    levels: list[Level] = field(default_factory=list)

    def log_probabilities(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """(keys, languages). Grams that no language has are looked up one symbol shorter; below single symbols all are equally likely."""
        if order == 0:
            return np.full((len(keys), len(self.languages)), -np.log(1 << BITS), np.float32)
        level = self.levels[order - 1]
        at = _places(level.keys, keys)
        p = level.seen[at] if len(level.keys) else np.zeros((len(keys), len(self.languages)), np.float32)
        new = np.flatnonzero(at < 0)
        if len(new):
            p[new] = self._backed_off(level, keys[new], order)
        return p

    def _backed_off(self, level: Level, keys: np.ndarray, order: int) -> np.ndarray:
        p = self.log_probabilities(_shorter(keys, order), order - 1)
        at = _places(level.contexts, _context(keys))
        met = np.flatnonzero(at >= 0)
        p[met] += level.left[at[met]]
        return p


def fit(counts: pa.Table) -> Model:
    """Interpolated Kneser-Ney from (lang, gram, n): shorter grams count the different symbols seen before them, not their occurrences."""
    names = counts.column("lang").combine_chunks().dictionary_encode()
    names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
    codes, known = names.indices.to_numpy(zero_copy_only=False), names.dictionary.to_pylist()
    grams_, n = counts.column("gram").to_numpy().astype(np.int64).view(np.uint64), counts.column("n").to_numpy()
    languages = sorted(known)
    own: list[list[tuple[np.ndarray, np.ndarray]]] = []  # by language: counts of whole grams, then shorter and shorter ones
    for language in languages:
        mine = codes == known.index(language)
        order = np.argsort(grams_[mine])
        steps = [(grams_[mine][order], n[mine][order])]
        for size in range(ORDER, 1, -1):
            steps.append(np.unique(_shorter(steps[-1][0], size), return_counts=True))
        own.append(steps[::-1])
    model = Model(languages)
    for order in range(1, ORDER + 1):
        keys = np.unique(np.concatenate([steps[order - 1][0] for steps in own] or [np.zeros(0, np.uint64)]))
        contexts = np.unique(_context(keys))
        level = Level(keys, np.zeros((len(keys), len(languages)), np.float32), contexts, np.zeros((len(contexts), len(languages)), np.float32))
        lower = model.log_probabilities(_shorter(keys, order), order - 1)
        place = _places(contexts, _context(keys))
        for j, steps in enumerate(own):
            k, c = steps[order - 1]
            n1, n2 = (c == 1).sum(), (c == 2).sum()
            discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            at = np.searchsorted(keys, k)
            total, kinds = np.bincount(place[at], c, len(contexts)), np.bincount(place[at], minlength=len(contexts))
            weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            level.left[:, j] = np.log(weight)
            level.seen[:, j] = level.left[place, j] + lower[:, j]
            level.seen[at, j] = np.log(np.maximum(c - discount, 0) / total[place[at]] + weight[place[at]] * np.exp(lower[at, j].astype(np.float64)))
        model.levels.append(level)
    return model


def entropies(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Mean surprise per symbol in nats, (texts, languages), and the symbols of each text."""
    key, first = grams(texts)
    sizes = np.diff(first)
    total = np.zeros((len(texts), len(model.languages)))
    full = np.flatnonzero(sizes)
    starts = first[:-1][full]
    for a in range(0, len(key), _AT_ONCE):  # a text may lie in several parts
        p = model.log_probabilities(key[a : a + _AT_ONCE])
        inside = slice(np.searchsorted(starts, a, "right") - 1, np.searchsorted(starts, a + len(p)))
        total[full[inside]] -= np.add.reduceat(p, np.maximum(starts[inside] - a, 0), axis=0, dtype=np.float64)
    return total / np.maximum(sizes, 1)[:, None], sizes


def gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows (_text, _lang). A task hands on its sums whenever it holds many, so it stays small on any corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merge() -> int:
            for name, parts in held.items():
                if len(parts) > 1:
                    k, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                    held[name] = [(k, np.bincount(inverse, np.concatenate([c for _, c in parts]), len(k)).astype(np.int64))]
            return sum(len(k) for parts in held.values() for k, _ in parts)

        def handed_on() -> Iterator[pa.RecordBatch]:
            for name, parts in held.items():
                for k, c in parts:
                    for a in range(0, len(k), 100_000):
                        part = k[a : a + 100_000].view(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(part), pa.string()), pa.array(part), pa.array(c[a : a + 100_000])], names=["lang", "gram", "n"])
            held.clear()

        waiting = 0
        for batch in batches:
            for part in slices(batch):
                by_lang: dict[str, list[str]] = {}
                for name, text in zip(part.column("_lang").to_pylist(), part.column("_text").to_pylist()):
                    by_lang.setdefault(name, []).append(text)
                for name, texts in by_lang.items():
                    found = np.unique(grams(texts)[0], return_counts=True)
                    held.setdefault(name, []).append(found)
                    waiting += len(found[0])
                if waiting > _HELD:
                    waiting = merge()
                    if waiting > _HELD // 2:
                        yield from handed_on()
                        waiting = 0
        merge()
        yield from handed_on()

    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _excess() -> Column:
    return (F.col("entropy") - F.col("mean")) * F.sqrt(F.least("n_symbols", F.lit(STEADY)))


def _calibration(table: DataFrame) -> tuple[np.ndarray, dict[str, tuple[float, float]]]:
    """From calibration rows: how often the best language is right by margin (rising), and for each language mean and limit of surprise."""
    learned = table.where("_calibrate and best is not null")
    bins = np.zeros((2, _BINS))
    for r in learned.groupBy("bin").agg(F.count("*").alias("n"), F.sum((F.col("best") == F.col("_lang")).cast("long")).alias("right")).collect():
        bins[:, r["bin"]] = r["right"], r["n"]
    blocks: list[list[float]] = []  # pool neighbours until shares rise with the margin
    for right, n in bins.T:
        blocks.append([right, n, 1])
        while len(blocks) > 1 and blocks[-2][0] / max(blocks[-2][1], 1e-9) >= blocks[-1][0] / max(blocks[-1][1], 1e-9):
            right, n, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + right, blocks[-1][1] + n, blocks[-1][2] + k]
    shares = np.concatenate([np.full(int(k), (right + 1) / (n + 2)) for right, n, k in blocks])
    agreed = learned.where("best = _lang")
    means = agreed.groupBy("best").agg(F.avg("entropy").alias("mean"))
    excess = _excess()
    # a row a language is broadcast: rows stay where they are and combine into sketches before the shuffle
    limits = agreed.join(F.broadcast(means), "best").groupBy("best", "mean").agg(F.percentile_approx(excess, F.lit(1 - REJECTED), F.lit(100_000)).alias("limit"))
    return shares, {r["best"]: (r["mean"], r["limit"]) for r in limits.collect()}  # one row a language


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", learn: str = "pmod(crc32(cast(_id as string)), 4) <> 2", carry: tuple[str, ...] = ("_text", "_row")) -> DataFrame:
    """Every row of ``docs`` as ``carry`` (see ``tables.packed``) with _id, learned, lang_pred, score, entropy and rejected.

    Rows for which ``learn`` (SQL over _id) holds and whose text and language are not null teach: one in CALIBRATION, by
    a hash of the id, serves for calibration, the grams of all others are counted over the whole table. A language
    without a calibration row rejects nothing. lang_pred is the language of lowest mean surprise per symbol, ties by name;
    ``und`` for null texts, texts without a letter, and where nothing was learned. score is the share of
    calibration rows with such a margin that were right. rejected: ``und``, or foreign (see
    SLACK) to the best language.
    Repeated rows are judged one by one; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    given = packed(docs, text).withColumn("_id", F.col(f"_row.{doc_id}")).withColumn("_lang", F.col(f"_row.{lang}").cast("string"))
    rows = given.withColumn("_learn", F.coalesce(F.expr(learn), F.lit(False)) & F.col("_lang").isNotNull() & F.col("_text").isNotNull())
    rows = rows.withColumn("_calibrate", F.col("_learn") & (F.pmod(F.xxhash64(F.lit("calibration"), F.col("_id").cast("string")), F.lit(CALIBRATION)) == 0))
    model = fit(gram_counts(rows.where("_learn and not _calibrate").select("_text", "_lang")).toArrow())
    shared = spark.sparkContext.broadcast(model)
    fields = [T.StructField("best", T.StringType()), T.StructField("entropy", T.DoubleType()), T.StructField("bin", T.LongType()), T.StructField("n_symbols", T.LongType())]

    def compute(part: pa.RecordBatch) -> list:
        model = shared.value
        texts = [t or "" for t in part.column("_text").to_pylist()]
        if not model.languages:
            return [[None] * len(texts), [None] * len(texts), [0] * len(texts), [0] * len(texts)]
        means, sizes = entropies(model, texts)
        best = means.argmin(axis=1)
        ordered = np.sort(means, axis=1)
        margin = ordered[:, 1] - ordered[:, 0] if len(model.languages) > 1 else np.ones(len(texts))
        bins = np.minimum((margin * 32).astype(np.int64), _BINS - 1)
        some = np.array([any(map(str.isalpha, t[:64])) or any(map(str.isalpha, t)) for t in texts], bool)
        names = [model.languages[b] if ok else None for b, ok in zip(best.tolist(), some)]
        return [names, np.where(some, ordered[:, 0], np.nan), bins, sizes]

    ids = ["_id", "_lang", "_learn", "_calibrate"]
    # where rows are handed on, only calibration rows are scored here, and no copy of the texts is stored
    table = stored(each_slice(rows.where("_calibrate") if carry else rows, compute, fields, ids))
    shares, limits = _calibration(table)
    if carry:
        table = each_slice(rows, compute, fields, [*carry, *ids])
    score = F.element_at(F.array(*[F.lit(float(s)) for s in shares]), (F.col("bin") + 1).cast("int"))
    known = spark.createDataFrame([(k, float(m), float(z)) for k, (m, z) in limits.items()], "best string, mean double, limit double")
    out = table.join(F.broadcast(known), "best", "left")  # one row a language
    foreign = _excess() > F.greatest(SLACK * F.col("limit"), F.lit(STEADY**0.5))
    return out.select(*carry, "_id", F.col("_learn").alias("learned"), F.coalesce("best", F.lit(UNKNOWN)).alias("lang_pred"),
                      F.when(F.col("best").isNull(), 0.0).otherwise(score).alias("score"), "entropy",
                      (F.col("best").isNull() | F.coalesce(foreign, F.lit(False))).alias("rejected"))


def known_language(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is recognised, all columns as they were."""
    return unpacked(identify(docs, text).where("not rejected"), docs.columns, text)
