"""Token ids of texts by way of pieces that the tokenizer treats alone, each encoded once and remembered."""

from __future__ import annotations

import json
import os
import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from storelens.llm.tables import SLICE_BYTES, held

#: Pieces remembered by one Python worker; then it starts anew. Bounds memory, not results.
REMEMBERED = 1_000_000
#: Bytes of the remembered units, for each that may be remembered; scripts without spaces have long units.
UNIT_BYTES = 64
#: A pre-token of the byte-level pattern never goes on over white space that follows a visible
#: character, so a text may be cut in front of such a space without changing its ids.
_CUT = re.compile(r"(?<=\S) ")
_UNSAFE = re.compile(r"\s ")

# Classes of bytes: unknown (white space to some, or beyond ASCII), letter, digit, punctuation, apostrophe, other visible, space, other white space.
_ODD, _LETTER, _DIGIT, _POINT, _APOSTROPHE, _OTHER, _SPACE, _BREAK = range(8)
_VISIBLE = (_LETTER, _DIGIT, _POINT, _APOSTROPHE, _OTHER)
_CLASS = np.full(256, _OTHER, np.uint8)
for _c in range(0x21, 0x7F):
    _CLASS[_c] = _LETTER if chr(_c).isalpha() else _DIGIT if chr(_c).isdigit() else _APOSTROPHE if chr(_c) == "'" else _POINT
_CLASS[0x1C:0x20] = _ODD
_CLASS[9:14] = _BREAK
_CLASS[0x20] = _SPACE
_LEADS = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])  # first bytes of white space beyond ASCII


def _rules(pairs: tuple[tuple[int, int], ...], breaks: bool) -> np.ndarray:
    """For two classes in a row (8 * first + second): 1 for a cut between them, 2 for a cut in front of the first."""
    rule = np.zeros((8, 8), np.uint8)
    for v in _VISIBLE:
        rule[v, _SPACE] = 1
        if breaks:
            rule[v, _BREAK], rule[_SPACE, v], rule[_BREAK, v] = 1, 2, 3
    for a, b in pairs:
        rule[a, b] = 1
    return rule.reshape(-1)


#: Cuts that any byte-level pattern allows, and all that the pattern of GPT-2 shows by two bytes: the last of several white spaces stands
#: alone or, if it is a space, leads the next word; words, numbers and punctuation part, but for what may follow an apostrophe.
_COARSE = _rules((), False)
_FINE = _rules(((_LETTER, _DIGIT), (_DIGIT, _LETTER), (_LETTER, _POINT), (_LETTER, _APOSTROPHE), (_DIGIT, _POINT), (_DIGIT, _APOSTROPHE), (_POINT, _LETTER), (_POINT, _DIGIT)), True)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pieces(text: str) -> list[str]:
    """Pieces whose ids, one after another, are the ids of the text."""
    cuts = [m.start() for m in _CUT.finditer(text)]
    return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)]) if b > a]


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each value begins, with the end of the last one, and the bytes of all in a row; without copying them."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, places, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint8)
    edges = np.frombuffer(places, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return edges - edges[0], np.frombuffer(data, np.uint8)[edges[0] : edges[-1]]


def _classes(data: np.ndarray) -> np.ndarray:
    """The class of each byte of UTF-8; all bytes of white space beyond ASCII are odd."""
    kinds = _CLASS[data]
    at = np.flatnonzero(_LEADS[data]) if len(data) and data.max() > 0x7F else ()
    if len(at):
        a, b, c = data[at], data[np.minimum(at + 1, len(data) - 1)], data[np.minimum(at + 2, len(data) - 1)]
        two = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
        three = (a == 0xE1) & ((b == 0x9A) & (c == 0x80) | (b == 0xA0) & (c == 0x8E)) | (a == 0xE3) & (b == 0x80) & (c == 0x80)
        three |= (a == 0xE2) & ((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F))
        for k, which in ((0, two | three), (1, two | three), (2, three)):
            kinds[at[which] + k] = _ODD
    return kinds


class PieceEncoder:
    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Each character of a byte-level token stands for one byte.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        made = json.loads(self.tokenizer.to_str())
        pattern = made["pre_tokenizer"] or {}
        self.added = [t["content"] for t in made["added_tokens"]]
        self.fine = pattern.get("type") == "ByteLevel" and pattern.get("use_regex", True) and not pattern.get("add_prefix_space") and not made["normalizer"]
        self.remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self.after_space: dict[str, int] = {}  # pieces without the space they begin with
        self.whole: dict[str, int] = {}
        self.units = pa.array([], pa.binary())
        self.unit_numbers = np.zeros(0, np.int32)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 14, np.int64)
        self.count = np.zeros(1 << 14, np.int64)
        self.n, self.used = 0, 0

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row and the number of each, for pieces that begin with a space and end visibly: they are
        encoded as one text, as no pre-token crosses from one to the next, and told apart by their bytes."""
        return self._parted("".join(pieces), np.fromiter((len(p.encode("utf-8", "surrogatepass")) for p in pieces), np.int64, len(pieces)))

    def _parted(self, text: str, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``text`` and how many of them each run of ``sizes`` bytes has."""
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        at = np.cumsum(self.bytes[ids])
        ends = np.cumsum(sizes)
        last = np.searchsorted(at, ends)
        if len(sizes) and not (len(at) and at[-1] == ends[-1] and (at[last] == ends).all()):
            raise ValueError("this tokenizer does not keep to the bytes of a text")
        return ids, np.diff(last, prepend=-1)

    def _learn(self, known: dict[str, int], keys: list[str], prefix: str) -> None:
        whole = [prefix + p for p in keys]
        joined = [k for k, p in enumerate(whole) if p[:1] == " " and not p[-1:].isspace()]
        alone = sorted(set(range(len(whole))).difference(joined))
        order, ids, counts = joined + alone, [], []
        for k in range(0, len(joined), 2048):
            made, n = self._encoded([whole[i] for i in joined[k : k + 2048]])
            ids.append(made)
            counts.append(n)
        made = [x.ids for x in self.tokenizer.encode_batch_fast([whole[i] for i in alone], add_special_tokens=False)]
        ids.append(np.fromiter(chain.from_iterable(made), np.uint32))
        counts.append(np.fromiter(map(len, made), np.int64, len(made)))
        ids, counts = np.concatenate(ids), np.concatenate(counts)
        known.update(zip((keys[i] for i in order), self._keep(ids, counts).tolist()))

    def _keep(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Numbers given to pieces with these ids, ``counts`` for each."""
        while self.n + len(counts) > len(self.start):
            self.start, self.count = np.resize(self.start, 2 * len(self.start)), np.resize(self.count, 2 * len(self.count))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[self.used : self.used + len(ids)] = ids
        self.start[self.n : self.n + len(counts)] = self.used + np.cumsum(counts) - counts
        self.count[self.n : self.n + len(counts)] = counts
        self.n, self.used = self.n + len(counts), self.used + len(ids)
        return np.arange(self.n - len(counts), self.n)

    def _numbers(self, known: dict[str, int], pieces: list[str], prefix: str) -> np.ndarray:
        found = np.array(list(map(known.get, pieces, repeat(-1))), np.int64)
        new = np.flatnonzero(found < 0)
        if len(new):
            missing = [pieces[i] for i in new.tolist()]
            self._learn(known, list(dict.fromkeys(missing)), prefix)
            found[new] = list(map(known.__getitem__, missing))
        return found

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers and characters of the pieces of all texts in a row, and how many pieces each text has. Valid until the next call."""
        if self.n > self.remembered:
            self._forget()
        whole, after, split, counts = [], [], [], []
        for text in texts:
            if _UNSAFE.search(text):
                parts = split_pieces(text)
                whole += parts
                split.append(len(parts))
            else:
                parts = text.split(" ")
                whole.append(parts[0])
                after += parts[1:]
                split.append(1)
            counts.append(len(parts))
        counts = np.array(counts, np.int64)
        # Of each text the first pieces are looked up as they are (all of them where white space is odd), the rest without their space.
        nth = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        leads = nth < np.repeat(np.array(split, np.int64), counts)
        numbers, sizes = np.empty(len(leads), np.int64), np.empty(len(leads), np.int64)
        numbers[leads], numbers[~leads] = self._numbers(self.whole, whole, ""), self._numbers(self.after_space, after, " ")
        sizes[leads], sizes[~leads] = np.fromiter(map(len, whole), np.int64, len(whole)), np.fromiter(map(len, after), np.int64, len(after)) + 1
        return numbers, sizes, counts

    def _cuts(self, texts: pa.Array, edges: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Where units begin, with the end of the last: places that no pre-token crosses and where nothing before changes what follows."""
        kinds = _classes(data)
        pairs = (kinds[:-1] << 3) | kinds[1:]
        rule = (_FINE if self.fine else _COARSE)[pairs]
        inner = edges[(edges > 0) & (edges < len(data))]
        rule[inner - 1] = 0
        if self.fine:  # an added token ends a run of white space like the end of a text
            for token in self.added:
                for k in np.flatnonzero(np.asarray(pc.match_substring(texts, token))):
                    rule[edges[k] : edges[k + 1] - 1] = _COARSE[pairs[edges[k] : edges[k + 1] - 1]]
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = rule & 1
        cut[: max(len(data) - 1, 0)] |= rule > 1
        cut[edges] = True
        return np.flatnonzero(cut)

    def _learn_units(self, new: pa.Array) -> np.ndarray:
        """Numbers of units that are not known yet."""
        edges, data = _bytes(new)
        kinds, sizes, units = _classes(data), np.diff(edges), new.to_pylist()
        first, last = kinds[edges[:-1]], np.isin(kinds[edges[1:] - 1], _VISIBLE)
        spaced = (first == _SPACE) & last
        bare = np.isin(first, _VISIBLE) & last if self.fine else np.zeros(len(spaced), bool)
        order, ids, counts = [], [], []
        for which, end in ((spaced, ""), (bare, "\n")):  # a line break between visible characters is a pre-token of its own
            places = np.flatnonzero(which)
            for k in range(0, len(places), 2048):
                some = places[k : k + 2048]
                text = end.join([*(units[i].decode() for i in some.tolist()), ""]) if end else b"".join([units[i] for i in some.tolist()]).decode()
                made, n = self._parted(text, sizes[some] + len(end))
                if end:
                    ends = np.cumsum(n) - 1
                    if not (self.bytes[made[ends]] == 1).all():
                        raise ValueError("this tokenizer does not keep line breaks apart")
                    made, n = np.delete(made, ends), n - 1
                order.append(some)
                ids.append(made)
                counts.append(n)
        alone = np.flatnonzero(~spaced & ~bare)
        made = [x.ids for x in self.tokenizer.encode_batch_fast([units[i].decode() for i in alone.tolist()], add_special_tokens=False)]
        order.append(alone)
        ids.append(np.fromiter(chain.from_iterable(made), np.uint32))
        counts.append(np.fromiter(map(len, made), np.int64, len(made)))
        numbers = np.empty(len(units), np.int32)
        numbers[np.concatenate(order)] = self._keep(np.concatenate(ids), np.concatenate(counts))
        return numbers

    def unit_numbers_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the units (words, numbers, punctuation, white space) of all texts in a row, and where those of each text begin, with
        the end of the last. Null texts have none. Valid until the next call, which looks all different units up at once."""
        if self.n > self.remembered or self.units.nbytes > UNIT_BYTES * self.remembered:
            self._forget()
        texts = pc.fill_null(texts, "")
        edges, data = _bytes(texts)
        firsts = np.flatnonzero(np.diff(edges[:-1] // SLICE_BYTES, prepend=-1)).tolist()  # cut slice by slice, to hold less at a time
        found_at = [np.zeros(0, np.int32)]
        for a, b in zip(firsts, [*firsts[1:], len(texts)]):
            some = self._cuts(texts.slice(a, b - a), edges[a : b + 1] - edges[a], data[edges[a] : edges[b]])
            found_at.append((some[:-1] + edges[a]).astype(np.int32))
        at = np.concatenate([*found_at, np.array([len(data)], np.int32)])
        del found_at
        units = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)]).dictionary_encode()
        found = pc.index_in(units.dictionary, value_set=self.units)
        new = units.dictionary.filter(found.is_null())
        if len(new):
            self.unit_numbers = np.concatenate([self.unit_numbers, self._learn_units(new)])
            numbers = np.array(found.fill_null(-1))
            numbers[numbers < 0] = np.arange(len(self.units), len(self.units) + len(new))
            self.units = pa.concat_arrays([self.units, new])
        else:
            numbers = np.asarray(found)
        return self.unit_numbers[numbers][np.asarray(units.indices)], np.searchsorted(at, edges)

    def ids_of(self, numbers: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of numbered pieces in a row (uint32), and how many the pieces from each edge to the next have."""
        counts = self.count[numbers]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.start[numbers] - (ends - counts), counts)
        reached = np.concatenate([[0], ends])
        return self.ids[at], np.diff(reached[edges])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts in a row (uint32), and the number of ids of each text."""
        return self.ids_of(*self.unit_numbers_of(pa.array(texts, pa.string())))


def encoder_key(path: str, remembered: int = REMEMBERED) -> str:
    return f"{path} {remembered}"


def encoder(path: str, remembered: int = REMEMBERED) -> PieceEncoder:
    """One encoder for each Python worker, kept over its tasks until another operator works there."""
    return held(encoder_key(path, remembered), lambda: PieceEncoder(path, remembered))
