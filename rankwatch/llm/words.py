"""Whole UTF-8 texts of an Arrow batch as numpy arrays: classes, pieces, hashes.

A batch is worked through in blocks of half a megabyte, so the memory of a task does
not follow the size of its partition. A text longer than a block is cut between an ASCII letter
and a blank that a letter follows; such a place ends a word for every splitter here, so the
pieces of the parts are the pieces of the whole.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# Code points below this are told apart by tables; texts with others go to the library.
PLAIN = 0x180
_ODD = (0x130,)


def _class_of(cp: int) -> int:
    if cp in (9, 10, 11, 12, 13, 32, 0xA0):
        return SPACE
    kind = unicodedata.category(chr(cp))[0]
    return LETTER if kind == "L" else NUMBER if kind == "N" else OTHER


CLASSES = np.array([_class_of(c) for c in range(PLAIN)], dtype=np.uint8)
_BYTE_CLASS = np.concatenate([CLASSES[:128], np.zeros(128, np.uint8)])
LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32
_LOWER = np.array([ord(chr(c).lower()) if c not in _ODD else c for c in range(PLAIN)])
# The controls that some engines count as white space and others do not, and 0x85.
_ODD_BYTE = np.zeros(256, bool)
_ODD_BYTE[[*range(0, 9), *range(14, 32), 127]] = True
_ODD_BYTE[0xC6:] = True

_rng = np.random.default_rng(20240229)
_BYTE_MIX = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    while len(_powers) < n:
        _powers = np.concatenate([_powers, _powers * (_powers[-1:] * _BASE)])
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Block:
    """Bytes of consecutive texts (or of a part of one) and where each begins."""

    docs: np.ndarray  # position in the batch
    data: np.ndarray
    starts: np.ndarray

    def ends(self) -> np.ndarray:
        return np.append(self.starts[1:], len(self.data))

    def part(self, i: int) -> bytes:
        stop = self.starts[i + 1] if i + 1 < len(self.starts) else len(self.data)
        return self.data[self.starts[i] : stop].tobytes()


def buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_string()).fill_null("")
    _, offs, data = array.buffers()
    offsets = np.frombuffer(offs, np.int64)[array.offset : array.offset + len(array) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets, raw


def _cuts(text: np.ndarray, limit: int) -> list[int]:
    """Where a long text may be cut: before a blank between two ASCII letters."""
    letter = (LOWER_ASCII[text] >= 97) & (LOWER_ASCII[text] <= 122)
    good = np.flatnonzero((text[1:-1] == 32) & letter[:-2] & letter[2:]) + 1
    cuts, at = [0], 0
    while at + limit < len(text):
        k = np.searchsorted(good, at + limit)
        if k >= len(good):
            break
        at = int(good[k])
        cuts.append(at)
    return [*cuts, len(text)]


def blocks(array: pa.Array, limit: int = BLOCK) -> Iterator[Block]:
    """All non-empty texts in order, about `limit` bytes at a time."""
    offsets, raw = buffers(array)
    i, n = 0, len(offsets) - 1
    while i < n:
        size = offsets[i + 1] - offsets[i]
        if size > 2 * limit:
            text = raw[offsets[i] : offsets[i + 1]]
            cuts = _cuts(text, limit)
            for a, b in zip(cuts, cuts[1:], strict=False):
                yield Block(np.array([i]), text[a:b], np.zeros(1, np.int64))
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        while j > i + 1 and offsets[j] - offsets[j - 1] > 2 * limit:
            j -= 1
        lengths = np.diff(offsets[i : j + 1])
        keep = np.flatnonzero(lengths > 0)
        if len(keep):
            yield Block(keep + i, raw[offsets[i] : offsets[j]], offsets[i:j][keep] - offsets[i])
        i = j


def doc_of(positions: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which part of the block each byte position is in."""
    return np.searchsorted(starts, positions, "right") - 1


def classes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class per byte (all bytes of a character share it) and which bytes are odd."""
    cls = _BYTE_CLASS[data]
    odd = _ODD_BYTE[data]
    lead = np.flatnonzero((data >= 0xC2) & (data <= 0xC5))
    if len(lead):
        cp = ((data[lead] & 0x1F).astype(np.int64) << 6) | (data[lead + 1] & 0x3F)
        kind = CLASSES[cp]
        cls[lead] = kind
        cls[lead + 1] = kind
        odd[lead] |= (cp == 0x130) | (cp < 0xA0)
    return cls, odd


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of plain texts; every letter keeps its number of bytes."""
    out = LOWER_ASCII[data]
    lead = np.flatnonzero((data >= 0xC2) & (data <= 0xC5))
    if len(lead):
        cp = _LOWER[((data[lead] & 0x1F).astype(np.int64) << 6) | (data[lead + 1] & 0x3F)]
        out[lead] = 0xC0 | (cp >> 6)
        out[lead + 1] = 0x80 | (cp & 0x3F)
    return out


def span_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; the spans are disjoint, ordered and not empty."""
    if not len(begins):
        return np.zeros(0, np.uint64)
    lengths = ends - begins
    at = np.repeat(begins - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    at += np.arange(len(at))
    place = at - np.repeat(begins, lengths)
    p = powers(int(lengths.max()))
    terms = _BYTE_MIX[data[at]] * p[place]
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    return mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64) * _BASE)


def runs(cls: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of maximal runs of one class that do not cross texts."""
    edge = np.empty(len(cls), bool)
    edge[0] = True
    np.not_equal(cls[1:], cls[:-1], out=edge[1:])
    edge[starts] = True
    begin = np.flatnonzero(edge)
    return begin, np.append(begin[1:], len(cls))


def split_runs(mask: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the maximal runs of marked bytes."""
    begin, end = runs(mask.view(np.uint8), starts)
    keep = mask[begin]
    return begin[keep], end[keep]


_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True


def white_words(block: Block, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(data, begins, ends) of the words between ASCII white space."""
    data = LOWER_ASCII[block.data] if lower else block.data
    return (data, *split_runs(~_WHITE[data], block.starts))


class Memo:
    """Values by 64-bit key in sorted arrays; emptied when it holds `most` keys, so a worker's
    memory is bounded whatever the vocabulary. It saves work and changes no result."""

    def __init__(self, width: int = 0, dtype=np.float64, most: int = 1 << 20):
        self.width, self.dtype, self.most = width, dtype, most
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.values = np.zeros((0, self.width) if self.width else 0, self.dtype)

    def get(self, keys: np.ndarray, make: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Values of distinct sorted keys; `make` gets the positions of the unknown ones."""
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        out = np.zeros((len(keys), *self.values.shape[1:]), self.dtype)
        out[known] = self.values[at[known]]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            out[fresh] = make(fresh)
            if len(self.keys) + len(fresh) > self.most:
                self.clear()
                at = np.zeros(len(keys), np.int64)
            if len(fresh) <= self.most:
                self.keys = np.insert(self.keys, at[fresh], keys[fresh])
                self.values = np.insert(self.values, at[fresh], out[fresh], axis=0)
        return out
