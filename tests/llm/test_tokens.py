"""Piece-wise token ids, packing and edit-aware counts against the tokenizer itself."""

import random
import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest

from storelens.llm import packing, token_counts
from storelens.llm.pieces import PieceEncoder, split_pieces, tokenizer_path

ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b\n\nc", "it's we'll  don't", "tab\t end", "nb sp  em  x", "x<|endoftext|>y z <|endoftext|> ", "日本 語\U0001f600 ok", "12 345 -- !! a.b"]


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pieces_give_the_tokenizers_ids(plain):
    texts = [*ODD, *(t or "" for t in cases.TEXTS), *(t or "" for t in cases.table("documents")["text"])]
    made = PieceEncoder(tokenizer_path(), remembered=500)
    for k in range(0, len(texts), 7):
        ids, counts = made.encode(texts[k : k + 7])
        at = 0
        for text, n in zip(texts[k : k + 7], counts):
            assert ids[at : at + n].tolist() == plain(text)
            at += n
    assert all("".join(split_pieces(t)) == t for t in texts)


def test_units_give_the_tokenizers_ids(plain):
    signs = ["a", "Bc", "ll", "s", "t", "re", "7", "42", "'", ".", ",", "|", "-", "<", "|>", "<|endoftext|>", " ", " ", " ", "\n", "\n", "\t", "\r", "\x0b", "\x00", "\x1c", "\x7f"]
    signs += ["\x85", "\xa0", "\u1680", "\u180e", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "\u200b", "é", "e\u0301", "日本", "。", "٣", "½", "\U0001f600", "ǅ"]
    r, made = random.Random(8), PieceEncoder(tokenizer_path(), remembered=3000)
    for _ in range(60):
        some = r.sample(signs, r.choice([3, 6, len(signs)]))
        texts = ["".join(r.choices(some, k=r.choice([0, 1, 2, 5, 40]))) for _ in range(60)]
        ids, counts = made.encode(texts)
        at = np.cumsum([0, *counts])
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [plain(t) for t in texts]


def test_units_of_another_pattern_are_cut_at_spaces_only(tmp_path):
    from tokenizers import Regex, Tokenizer, pre_tokenizers

    other = Tokenizer.from_file(tokenizer_path())
    split = pre_tokenizers.Split(Regex(r" ?[^\s]+[\r\n]*|\s+(?!\S)|\s+"), "isolated")
    other.pre_tokenizer = pre_tokenizers.Sequence([split, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    other.save(str(tmp_path / "other.json"))
    texts = ["it's 12ab.\n\nNext, one\n two  three\n", " a.b", "x", "", "日本 語。 z"]
    ids, counts = PieceEncoder(str(tmp_path / "other.json")).encode(texts)
    assert ids.tolist() == [i for t in texts for i in other.encode(t, add_special_tokens=False).ids]
    assert counts.tolist() == [len(other.encode(t, add_special_tokens=False).ids) for t in texts]


class Counting:
    """A tokenizer that counts the characters it encodes."""

    def __init__(self, tokenizer):
        self.tokenizer, self.chars = tokenizer, 0

    def encode_batch_fast(self, texts, **how):
        self.chars += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **how)


def test_words_are_encoded_once_whatever_stands_beside_them(plain):
    words = ["".join(p) for p in zip("abcdefghijklmnopqrst" * 2, "tion" * 10, "hereandthere" * 4)]
    texts = [f"{a}{sign}{b}" for a in words for sign in (".\n", ", ", "\n\n", " | ") for b in words]
    made = PieceEncoder(tokenizer_path())
    made.tokenizer = Counting(made.tokenizer)
    ids, _ = made.encode(texts)
    assert ids.tolist() == [i for t in texts for i in plain(t)]
    assert made.tokenizer.chars < 10 * sum(map(len, words))  # not once for every text


def test_long_units_are_forgotten_by_their_bytes(plain):
    made = PieceEncoder(tokenizer_path(), remembered=50)
    for k in range(20):
        text = "日本" * 300 + str(k) + "語" * 300
        assert made.encode([text])[0].tolist() == plain(text)
    assert made.units.nbytes < 3 * 50 * 64 + 6000


def test_slices_of_a_batch_keep_their_texts(plain, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(packing, "LOOKUP_BYTES", 3000)
    texts = [None, "", *(t for t in cases.TEXTS), *(cases.prose(200, k) for k in range(40)), None, " x"]
    made, seen = PieceEncoder(tokenizer_path()), []
    for kind in (pa.string(), pa.large_string()):
        batch = pa.RecordBatch.from_arrays([pa.array([None, "cut off", *texts, "off"], kind)], names=["_text"]).slice(2, len(texts))
        for part, ids, counts in packing.encoded(made, batch):
            assert ids.tolist() == [i for t in part.column("_text").to_pylist() for i in plain(t)]
            assert counts.tolist() == [len(plain(t)) for t in part.column("_text").to_pylist()]
            seen += part.column("_text").to_pylist()
    assert seen == texts * 2


def check_packing(rows, docs, plain, capacity=2048):
    ids = [(d, np.array([*plain(t), 1], "<u4")) for d, t in docs]
    want = Counter((d, s, min(capacity, len(x) - s), zlib.crc32(x[s : s + capacity].tobytes()), len(x)) for d, x in ids for s in range(0, len(x), capacity))
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length, r.sequence_size))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length, size in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity and {size for *_, size in parts} == {at if at & (at - 1) == 0 else capacity}
    return len(sequences), sum(r.length for r in rows)


def test_awkward_documents_are_packed_whole(spark, plain):
    rows = packing.pack(cases.documents(spark)).collect()
    check_packing(rows, [r[:2] for r in cases.rows()], plain)
    assert packing.pack(cases.empty(spark)).count() == 0


def test_small_table_is_packed_with_little_padding(spark, plain):
    d = cases.table("documents")
    rows = packing.pack(spark.read.parquet(f"{cases.SF}/documents.parquet")).collect()
    n, tokens = check_packing(rows, list(zip(d["doc_id"], d["text"])), plain)
    assert n <= 1.03 * -(-tokens // 2048)


def test_many_copies_of_one_length(spark, plain):
    docs = [(i, None) for i in range(5000)] + [(9000 + i, "word " * 1500) for i in range(3)]
    rows = packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), capacity=1024).collect()
    n, tokens = check_packing(rows, docs, plain, 1024)
    assert n <= -(-tokens // 1024) + 3


def test_histogram_places_every_length_once():
    r = np.random.default_rng(3)
    for capacity in (16, 100):
        counts = np.append(0, r.integers(0, 50, capacity))
        packs = packing.pack_histogram(counts, capacity)
        placed = np.zeros(capacity + 1, int)
        for runs, n in packs:
            assert n > 0 and sum(length * copies for length, copies in runs) <= capacity
            for length, copies in runs:
                placed[length] += copies * n
        assert (placed == counts).all()
        # any rule that opens a pack only where none has room stays under this
        assert sum(n for _, n in packs) <= 1.7 * (counts * np.arange(capacity + 1)).sum() / capacity + 1
    assert packing.pack_histogram(np.zeros(5, int), 4) == []


def test_shortest_pack_takes_the_next_length():
    counts = np.zeros(11, int)
    counts[[7, 6, 3]] = 1, 1, 1
    assert sorted(packing.pack_histogram(counts, 10)) == [(((6, 1), (3, 1)), 1), (((7, 1),), 1)]


def test_trees_follow_edits_like_a_full_count(plain):
    made, r = PieceEncoder(tokenizer_path()), random.Random(4)
    for text in [*(t or "" for t in cases.TEXTS[:10]), cases.prose(900, 1), "x" * 3000, "a " * 700, "  \n " * 300, *ODD]:
        (leaves,) = token_counts.text_leaves(made, [text])
        tree = token_counts.TokenTree(*leaves)
        assert tree.total() == (len(text), len(plain(text)))
        for _ in range(25):
            pos, deleted = r.randint(0, len(text) + 3), r.choice([0, 0, 1, 2, 30, 700])
            inserted = r.choice(["", " ", "a", " word", "\n\n", "it's ", "x " * 600, "é"])
            text, tree, encoded = token_counts.apply_edit(made, text, tree, pos, deleted, inserted)
            assert tree.total() == (len(text), len(plain(text)))
            assert tree.leaves()[0].sum() == len(text)


def test_an_edit_encodes_a_small_region():
    made, text = PieceEncoder(tokenizer_path()), cases.prose(20_000, 2)
    (leaves,) = token_counts.text_leaves(made, [text])
    _, _, encoded = token_counts.apply_edit(made, text, token_counts.TokenTree(*leaves), len(text) // 2, 3, "edit")
    assert encoded <= 3 * (token_counts.LEAF_CHARS + 20)


def test_table_of_edits(spark, plain):
    edits = """array(named_struct('pos', 3L, 'deleted', 2L, 'inserted', _row.source), named_struct('pos', 1000000L, 'deleted', 1L, 'inserted', cast(null as string)))"""
    out = token_counts.apply_edits(token_counts.count_tokens(cases.documents(spark)), edits, carry=("_text", "_row"))

    def after(text, source):
        text = text or ""
        return text[:3] + (source or "") + text[5:]

    want = Counter((d, len(plain(t)), len(plain(after(t, s))), len(after(t, s))) for d, t, _, s, *_ in cases.rows())
    got = Counter(tuple(r) for r in out.select("_row.doc_id", "n_tokens", "n_tokens_edited", "n_chars_edited").collect())
    assert got == want
    same = token_counts.apply_edits(token_counts.count_tokens(cases.documents(spark)), "null").where("n_tokens <> n_tokens_edited")
    assert same.count() == 0
    assert token_counts.count_tokens(cases.empty(spark)).count() == 0


def test_query_counts_edited_texts(spark, plain):
    from storelens.llm.queries import op9_token_counts

    got = {r.doc_id: r.n_tokens_edited for r in op9_token_counts(spark, cases.SF).collect()}
    d = cases.table("documents")
    for doc, t, lang, source in zip(d["doc_id"], d["text"], d["lang"], d["source"]):
        n = len(t)
        t = t[: n // 2] + f" [{source}]" + t[n // 2 :]
        t = t[: n // 4] + t[n // 4 + 25 :]
        assert got[doc] == len(plain(lang + t[5:]))
