"""Token counts that follow edits: segment trees over leaves of pre-tokens, re-encoded only where a text changed."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm.pieces import PieceEncoder, encoder, encoder_key, tokenizer_path
from storelens.llm.tables import each_slice, packed

#: Characters that a leaf holds at least, where the text can be cut; a leaf grown beyond the second figure is split.
LEAF_CHARS = 256
SPLIT_CHARS = 4 * LEAF_CHARS
EDITS = "array<struct<pos:bigint,deleted:bigint,inserted:string>>"


class TokenTree:
    """Characters and tokens of the leaves of one text, with their sums in a binary tree stored as an array."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.size = 1 << max(0, int(len(chars) - 1).bit_length())
        self.sums = np.zeros((2, 2 * self.size), np.int64)
        self.sums[0, self.size : self.size + len(chars)] = chars
        self.sums[1, self.size : self.size + len(tokens)] = tokens
        level = self.size
        while level > 1:
            self.sums[:, level // 2 : level] = self.sums[:, level : 2 * level : 2] + self.sums[:, level + 1 : 2 * level : 2]
            level //= 2

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        chars, tokens = self.sums[:, self.size :]
        return chars[chars > 0], tokens[chars > 0]

    def total(self) -> tuple[int, int]:
        return int(self.sums[0, 1]), int(self.sums[1, 1])

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at ``place``, and where it starts; at the end of the text, the last leaf with characters."""
        place = min(place, max(0, self.total()[0] - 1))
        node, start = 1, 0
        while node < self.size:
            node *= 2
            left = int(self.sums[0, node])
            if place >= start + left:
                start, node = start + left, node + 1
        return node - self.size, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        """New figures of a leaf; the sums above it follow."""
        node = leaf + self.size
        change = np.array([chars - self.sums[0, node], tokens - self.sums[1, node]])
        while node:
            self.sums[:, node] += change
            node //= 2


def _leaves(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group pieces to leaves of LEAF_CHARS characters or more."""
    if not len(sizes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    block = (np.cumsum(sizes) - sizes) // LEAF_CHARS
    first = np.flatnonzero(np.diff(block, prepend=-1))
    chars, counts = np.add.reduceat(sizes, first), np.add.reduceat(tokens, first)
    return chars[chars > 0], counts[chars > 0]


def text_leaves(made: PieceEncoder, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    numbers, sizes, pieces = made.numbers(texts)
    edges, tokens = np.concatenate([[0], np.cumsum(pieces)]), made.count[numbers]
    return [_leaves(tokens[a:b], sizes[a:b]) for a, b in zip(edges, edges[1:])]


def apply_edit(made: PieceEncoder, text: str, tree: TokenTree, pos: int, deleted: int, inserted: str) -> tuple[str, TokenTree, int]:
    """The text and tree after one edit, and how many characters were encoded anew.

    Leaves begin in front of white space after a visible character, so their counts add up. The leaf
    before is taken along when the edit touches the first character of a leaf, and the leaf after it when
    the edit reaches the end of one: their common border may be gone. Places beyond the text are moved to its end.
    """
    total = tree.total()[0]
    pos = min(max(pos, 0), total)
    deleted = min(max(deleted, 0), total - pos)
    changed = text[:pos] + inserted + text[pos + deleted :]
    if not total:
        (chars, tokens), = text_leaves(made, [changed])
        return changed, TokenTree(chars, tokens), len(changed)
    low, start = tree.find(pos)
    if pos == start and start > 0 or pos == total:
        low, start = tree.find(start - 1) if pos == start else (low, start)
    high, at = tree.find(pos + deleted)
    end = at + int(tree.sums[0, high + tree.size])
    region = changed[start : end - deleted + len(inserted)]
    (chars, tokens), = text_leaves(made, [region])
    if len(region) > SPLIT_CHARS:  # split grown leaves; only their sums are built anew
        old_chars, old_tokens = tree.sums[0, tree.size :], tree.sums[1, tree.size :]
        chars = np.concatenate([old_chars[:low], chars, old_chars[high + 1 :]])
        tokens = np.concatenate([old_tokens[:low], tokens, old_tokens[high + 1 :]])
        return changed, TokenTree(chars[chars > 0], tokens[chars > 0]), len(region)
    for leaf in range(low + 1, high + 1):
        tree.put(leaf, 0, 0)
    tree.put(low, int(chars.sum()), int(tokens.sum()))
    return changed, tree, len(region)


def count_tokens(docs: DataFrame, text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Every row of ``docs`` as ``_text``, ``_row`` with n_tokens and its tree's leaves (leaf_chars, leaf_tokens).

    Null and empty texts have no leaves and no tokens. Repeated rows are counted one by one.
    """
    path = tokenizer or tokenizer_path()
    longs = T.ArrayType(T.LongType())
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("leaf_chars", longs), T.StructField("leaf_tokens", longs)]

    def compute(part: pa.RecordBatch) -> list:
        trees = text_leaves(encoder(path), [t or "" for t in part.column("_text").to_pylist()])
        return [[int(t.sum()) for _, t in trees], [c for c, _ in trees], [t for _, t in trees]]

    return each_slice(packed(docs, text), compute, fields, ["_text", "_row"], encoder_key(path))


def apply_edits(trees: DataFrame, edits: str, tokenizer: str | None = None, carry: tuple[str, ...] = ("_text", "_row")) -> DataFrame:
    """``trees`` after the edits of each row (SQL expression of type EDITS, applied one after another, places in code points).

    Gives ``carry`` as before the edits, n_tokens of before, and n_tokens_edited, n_chars_edited, n_chars_encoded,
    n_leaves, edited_leaf_chars, edited_leaf_tokens. Null edits change nothing; a null inserted text is empty.
    """
    path = tokenizer or tokenizer_path()
    longs = T.ArrayType(T.LongType())
    fields = [T.StructField(n, T.LongType()) for n in ("n_tokens_edited", "n_chars_edited", "n_chars_encoded", "n_leaves")]
    fields += [T.StructField(n, longs) for n in ("edited_leaf_chars", "edited_leaf_tokens")]

    def compute(part: pa.RecordBatch) -> list:
        made, rows = encoder(path), []
        columns = (part.column(c).to_pylist() for c in ("_text", "leaf_chars", "leaf_tokens", "_edits"))
        for text, chars, tokens, changes in zip(*columns):
            text, tree, encoded = text or "", TokenTree(np.array(chars, np.int64), np.array(tokens, np.int64)), 0
            for change in changes or []:
                text, tree, n = apply_edit(made, text, tree, change["pos"] or 0, change["deleted"] or 0, change["inserted"] or "")
                encoded += n
            chars, tokens = tree.leaves()
            rows.append((tree.total()[1], len(text), encoded, len(chars), chars, tokens))
        return [list(c) for c in zip(*rows)]

    given = trees.withColumn("_edits", F.expr(edits).cast(EDITS))
    return each_slice(given, compute, fields, [*carry, "n_tokens"], encoder_key(path))
