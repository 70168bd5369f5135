"""Words of many texts at once: byte-table tokenization and rolling 64-bit hashes in numpy.

Texts are UTF-8. Every separator is an ASCII byte, so whole bytes can be classified
by a table, and a character of several bytes is never cut.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from rillmark.llm.frames import text_column

SEGMENT = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15)

#: Lower-case of A-Z, other bytes as they are.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

#: Words between blanks: everything but \x20 and \x09-\x0D.
BETWEEN_BLANKS = np.ones(256, bool)
BETWEEN_BLANKS[[32, 9, 10, 11, 12, 13]] = False

#: Words of letters and digits: [0-9a-z] after folding, and every byte above ASCII.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[65:91] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]), dtype=np.uint64)


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64))
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_tables = (_powers(BASE, SEGMENT), _powers(_INVERSE, SEGMENT))


class Words(NamedTuple):
    """Words of consecutive texts. ``row``: which text; ``begin`` and ``end``: bytes in ``data``."""

    data: np.ndarray
    bounds: np.ndarray
    row: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def first(self) -> np.ndarray:
        """For each text, the index of its first word; one more entry for the end."""
        return np.searchsorted(self.row, np.arange(len(self.bounds)))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column and the bounds of each."""
    text = text_column(column)
    if not len(text):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    whole = text.buffers()[2]
    data = np.frombuffer(whole, np.uint8)[bounds[0] : bounds[-1]] if whole is not None and bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


def words_of(column: pa.Array, inside: np.ndarray = BETWEEN_BLANKS, hashed: bool = True, longest: int | None = None) -> Words:
    """All words of all texts, in order, with a hash of the folded bytes of each.

    With ``longest``, words of more bytes are taken as several words one behind the other.
    """
    data, bounds = utf8(column)
    is_word = inside[data]
    starts_row = np.zeros(len(data) + 1, bool)
    starts_row[bounds] = True
    previous = np.empty(len(data), bool)
    previous[:1] = False
    previous[1:] = is_word[:-1]
    begin = np.flatnonzero(is_word & (~previous | starts_row[:-1]))
    following = np.empty(len(data), bool)
    following[-1:] = False
    following[:-1] = is_word[1:]
    end = np.flatnonzero(is_word & (~following | starts_row[1:])) + 1
    if longest and len(begin) and int((end - begin).max()) > longest:
        pieces = -(-(end - begin) // longest)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin, end = np.repeat(begin, pieces) + nth * longest, np.repeat(end, pieces)
        end = np.minimum(end, begin + longest)
    row = np.searchsorted(bounds, begin, "right") - 1
    return Words(data, bounds, row, begin, end, _hashes(data, begin, end) if hashed else np.zeros(0, np.uint64))


def _hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of each word, taken as a difference of running sums over short segments."""
    out = np.empty(len(begin), np.uint64)
    k = 0
    with np.errstate(over="ignore"):
        while k < len(begin):
            base = begin[k]
            last = int(np.searchsorted(end, base + SEGMENT, "right"))
            if last <= k:
                out[k] = _long_hash(data[base : end[k]])
                k += 1
                continue
            size = int(end[last - 1] - base)
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(BYTE_VALUES[FOLD[data[base : base + size]]] * _tables[0][:size], out=sums[1:])
            b, e = begin[k:last] - base, end[k:last] - base
            out[k:last] = mixed((sums[e] - sums[b]) * _tables[1][b] + (e - b).astype(np.uint64))
            k = last
    return out


def _long_hash(word: np.ndarray) -> np.uint64:
    """The same hash of a word longer than a segment, piece by piece."""
    total = 0
    for a in range(0, len(word), SEGMENT):
        piece = word[a : a + SEGMENT]
        part = (BYTE_VALUES[FOLD[piece]] * _tables[0][: len(piece)]).sum(dtype=np.uint64)
        total += int(part) * pow(int(BASE), a, 1 << 64)
    return mixed(np.array([(total + len(word)) % (1 << 64)], np.uint64))[0]


def word_hash(word: str) -> np.uint64:
    return words_of(pa.array([word], pa.large_string()), np.ones(256, bool)).hash[0]


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-word shingles of each text: (row, hash), sorted by both, and the number of each text.

    A text with fewer than n words gives its whole sequence as one shingle, a text without words none.
    """
    first = words.first()
    counts = np.diff(first)
    with np.errstate(over="ignore"):
        total = max(0, len(words.hash) - n + 1)
        value = np.zeros(total, np.uint64)
        for k in range(n):
            value = value * BASE + words.hash[k : k + total]
        whole = words.row[:total] == words.row[n - 1 : n - 1 + total]
        row, value = words.row[:total][whole], mixed(value[whole] + np.uint64(n))
        short = np.flatnonzero((counts > 0) & (counts < n))
        if len(short):
            tail = np.zeros(len(short), np.uint64)
            for k in range(n - 1):
                has = counts[short] > k
                tail[has] = tail[has] * BASE + words.hash[first[short][has] + k]
            row = np.concatenate([row, short])
            value = np.concatenate([value, mixed(tail + counts[short].astype(np.uint64))])
    if len(short):
        order = np.argsort(row, kind="stable")
        row, value = row[order], value[order]
    edges = np.searchsorted(row, np.arange(len(counts) + 1))
    for a, b in zip(edges[:-1], edges[1:]):
        value[a:b].sort()
    keep = np.ones(len(row), bool)
    keep[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[keep], value[keep]
    return row, value, np.bincount(row, minlength=len(counts))
