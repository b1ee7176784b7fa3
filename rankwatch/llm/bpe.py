"""Byte-pair merges of many short pieces at once.

The vocabulary file gives symbols and ranked merges. Pieces of equal length form a matrix of
symbols; each round merges, in every row, the pair of the lowest rank (the leftmost of equal
ones) until no row has a pair left: what the tokenizer library does piece by piece.
"""

from __future__ import annotations

import json
from functools import cache

import numpy as np

LONGEST = 48
_NEVER = np.int32(2**31 - 1)


def byte_signs() -> dict[int, str]:
    """The printable sign that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in signs)
    return signs | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Merges:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        # Anything else than plain ranked merges over bytes is left to the library.
        self.usable = model.get("type", "BPE") == "BPE" and not any(
            model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
        )
        signs = byte_signs()
        self.usable &= all(s in vocab and s + suffix in vocab for s in signs.values())
        if not self.usable:
            return
        self.inner = np.array([vocab[signs[b]] for b in range(256)], np.int32)
        self.final = np.array([vocab[signs[b] + suffix] for b in range(256)], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.base = np.int64(max(vocab.values()) + 1)
        keys = np.array([vocab[a] * int(self.base) + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.base + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], _NEVER)

    def same_length(self, data: np.ndarray, begins: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, how many are left per row) of pieces of n bytes."""
        raw = data[begins[:, None] + np.arange(n)]
        symbols = self.inner[raw]
        symbols[:, -1] = self.final[raw[:, -1]]
        left = np.full(len(begins), n, np.int64)
        if n == 1:
            return symbols, left
        ranks = self.rank(symbols[:, :-1], symbols[:, 1:])
        rows = np.arange(len(begins))
        live = symbols.copy()
        while len(rows):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            more = best < _NEVER
            if not more.all():
                symbols[rows[~more], : live.shape[1]] = live[~more]
                rows, live, ranks, at, best = rows[more], live[more], ranks[more], at[more], best[more]
                if not len(rows):
                    break
            own = np.arange(len(rows))
            left[rows] -= 1
            live[own, at] = self.merged[best]
            width = live.shape[1] - 1
            after = np.arange(width)
            live = np.take_along_axis(live, after + (after > at[:, None]), axis=1)
            if width == 1:
                symbols[rows, :1] = live
                break
            slots = np.arange(width - 1)
            ranks = np.take_along_axis(ranks, slots + (slots >= at[:, None]), axis=1)
            # Rows hold as many symbols as there are columns: every live row merges each round.
            before = np.flatnonzero(at > 0)
            ranks[before, at[before] - 1] = self.rank(live[before, at[before] - 1], live[before, at[before]])
            behind = np.flatnonzero(at < width - 1)
            ranks[behind, at[behind]] = self.rank(live[behind, at[behind]], live[behind, at[behind] + 1])
        return symbols, left

    def encode(
        self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces one after another, ids per piece); none longer than LONGEST."""
        lengths = ends - begins
        counts = np.zeros(len(begins), np.int64)
        found = []
        for n in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == n)
            symbols, left = self.same_length(data, begins[own], n)
            counts[own] = left
            found.append((own, symbols, left))
        place = np.concatenate([[0], np.cumsum(counts)])
        ids = np.zeros(place[-1], np.uint32)
        for own, symbols, left in found:
            keep = np.arange(symbols.shape[1]) < left[:, None]
            to = (place[own][:, None] + np.arange(symbols.shape[1]))[keep]
            ids[to] = symbols[keep]
        return ids, counts


@cache
def merges(path: str) -> Merges:
    return Merges(path)
