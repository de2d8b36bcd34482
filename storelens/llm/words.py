"""Words of many texts at once, as byte positions and 64-bit hashes in numpy."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

#: ASCII letters and digits, and every byte of a code point above 127 (fixed by the operators' contracts).
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_BLOCK = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(1, 257, dtype=np.uint64)
_LOWER[65:91] = _LOWER[97:123]
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def lowered(text: str | None) -> bytes:
    """UTF-8 with A-Z in lower case; other letters stay as they are. Null is empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass").lower()


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=np.uint64)
    return _powers


def buffers(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and the offset of each (one more than texts). Nulls are empty."""
    text = text.fill_null("")
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    wide = text.type in (pa.large_string(), pa.large_binary())
    offsets = np.frombuffer(text.buffers()[1], np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    raw = text.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = WORD_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run of ``kind`` bytes, and the number of the first word of each text (one more than texts)."""
    inside = kind[data]
    full = offsets[:-1] < offsets[1:]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][full]] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[offsets[1:][full] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal for words that are equal up to the case of A-Z. Different words can collide, so callers compare bytes."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):  # blocks of words, so that memory does not grow with the text
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + _BLOCK)))
        low, high = int(starts[i]), int(ends[j - 1])
        up, down = _power_tables(high - low + 1)
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_LOWER[data[low:high]] * up[: high - low], out=total[1:])
        out[i:j] = (total[ends[i:j] - low] - total[starts[i:j] - low]) * down[starts[i:j] - low]
        i = j
    return mixed(out)
