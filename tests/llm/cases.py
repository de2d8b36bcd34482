"""Awkward documents that every operator has to take: nulls, empty and long texts, ties, repeated rows, clashing names."""

import random

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `_row` string, `_text` string, n_words long, score double, kept boolean, uid string, `a.b` int"

random.seed(5)
VOCABULARY = ["".join(random.choice("abdeilmnorstu") for _ in range(random.randint(2, 8))) for _ in range(400)]


def prose(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) + r.choice(["", "", "", ",", "."]) for _ in range(n))


TEXTS = [
    prose(60, 1), prose(60, 1), prose(60, 1) + " end", None, None, "", "  \n\t ", "one", "two words", "été déjà vu 中文字 \U0001f600 naïve",
    prose(30_000, 2), "same line\nsame line\nsame line\n" + prose(40, 3), "Released under the MIT License.", "### | $ % & <b> * " * 20, prose(400, 4), "x" * 50_000, "\\### Assistant: </turn>",
]


def rows() -> list[tuple]:
    out = [(i, t, ["en", "fr", None][i % 3], f"src{i % 2}", None, "r", "t", 7, 0.5, False, "u", 1) for i, t in enumerate(TEXTS)]
    out.append(out[0])  # a repeated row
    out.append((None, prose(50, 9), None, None, None, None, None, None, None, None, None, None))
    out.append((3, "other text under an id used before", "en", "src0", 1, None, None, None, None, None, None, None))
    return out


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(1, 0, 0), (None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")


def benchmark(spark):
    words = TEXTS[0].split()
    items = [(1, " ".join(words[10:30])), (2, "two words"), (None, " ".join(words[40:52])), (1, " ".join(words[10:30])), (4, None), (5, ""), (6, "never seen anywhere at all")]
    return spark.createDataFrame(items, "item_id long, text string")


def table(name: str, sf: str = SF):
    return pq.read_table(f"{sf}/{name}.parquet").to_pydict()
