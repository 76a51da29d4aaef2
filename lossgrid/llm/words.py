"""Words and their hashes for many texts at once, in numpy.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return; in
UTF-8 these bytes occur in no other character. Hashes are 64 bits wide, the same on every machine and in every
run, and depend on the bytes of the word alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import xxhash

from lossgrid.llm.arrow import spans_by_size

BLOCK_BYTES = 1 << 18
LONG_WORD = 1 << 16

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xFF51AFD7ED558CCD)
_MIX_B = np.uint64(0xC4CEB9FE1A85EC53)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX_A
    x = x ^ (x >> np.uint64(29))
    x = x * _MIX_B
    return x ^ (x >> np.uint64(32))


def seeds(n: int, salt: int = 0) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _MULTIPLY + np.uint64(salt))


_BYTE = seeds(256, 1)
_BYTE_POWER = np.uint64(0xD6E8FEB86659FD93)
_WORD_POWER = np.uint64(0xA0761D6478BD642F)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_INVERSE = np.uint64(pow(int(_BYTE_POWER), -1, 1 << 64))
_tables: dict[str, np.ndarray] = {}


def _table(name: str, base: np.uint64, n: int) -> np.ndarray:
    if name not in _tables or len(_tables[name]) < n:
        _tables[name] = _powers(base, max(n, 4096))
    return _tables[name]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span ``data[start:end]``; spans are ordered and do not overlap.

    Differences of one running sum of weighted bytes, cut into slices to bound memory. Spans longer than
    LONG_WORD bytes go through xxhash one by one.
    """
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        if int(ends[at]) - low > LONG_WORD:
            out[at] = xxhash.xxh64_intdigest(data[low : int(ends[at])].tobytes())
            at += 1
            continue
        to = int(np.searchsorted(ends, low + 4 * BLOCK_BYTES, "right"))
        to = max(at + 1, to)
        long = np.flatnonzero(ends[at:to] - starts[at:to] > LONG_WORD)
        if len(long):
            to = at + int(long[0])
        s, e = starts[at:to] - low, ends[at:to] - low
        n = int(e[-1])
        weighted = _BYTE[data[low : low + n]]
        weighted *= _table("power", _BYTE_POWER, n + 1)[:n]
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(weighted, out=total[1:])
        sums = (total[e] - total[s]) * _table("inverse", _INVERSE, n + 1)[s]
        out[at:to] = mix(sums + (e - s).astype(np.uint64))
        at = to
    return out


@dataclass
class Block:
    """Several whole texts laid end to end with a space between.

    ``starts`` and ``ends`` bound the words in ``data``; ``first`` has, per text, the number of its first word,
    and the number of words at the end.
    """

    docs: range
    data: np.ndarray
    text_starts: np.ndarray
    text_ends: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.docs)), self.counts())


def blocks(texts: Sequence[bytes], limit: int = BLOCK_BYTES) -> Iterator[Block]:
    for low, high in spans_by_size(map(len, texts), limit):
        part = texts[low:high]
        data = np.frombuffer(b" ".join(part) + b" ", np.uint8)
        sizes = np.fromiter(map(len, part), np.int64, len(part))
        text_starts = np.concatenate([[0], np.cumsum(sizes[:-1] + 1)]).astype(np.int64)
        word = ~IS_SPACE[data]
        edge = np.flatnonzero(word[1:] != word[:-1]) + 1
        if word[0]:
            edge = np.concatenate([[0], edge])
        starts, ends = edge[0::2], edge[1::2]
        first = np.append(np.searchsorted(starts, text_starts), len(starts))
        yield Block(range(low, high), data, text_starts, text_starts + sizes, starts, ends, first)


def ngram_hashes(hashes: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of ``n`` consecutive values, by its start; runs past the end are left out."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.full(count, np.uint64(salt) + np.uint64(n), np.uint64)
    for j in range(n):
        out *= _WORD_POWER
        out += hashes[j : j + count]
    return mix(out)
