"""Plain versions of what the operators compute, for small tables."""

import hashlib
import re

import numpy as np

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    n = max(1, len(words) - size + 1)
    return frozenset(tuple(words[i : i + size]) for i in range(n))


def components(texts, size, percent=80):
    """{id: smallest id reachable} by comparing all pairs."""
    sets = {i: shingles(t, size) for i, t in texts.items()}
    label = {i: i for i in texts}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(texts)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((root(i), root(j)))
                label[high] = low
    return {i: root(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(text, items, window=10):
    """(words, hit words, sorted ids of items with a window in the text)"""
    words = bench_words(text)
    hit, found = np.zeros(len(words), bool), set()
    for item_id, item in items:
        own = bench_words(item)
        n = min(window, len(own))
        for i in range(len(own) - n + 1 if n else 0):
            for j in range(len(words) - n + 1):
                if words[j : j + n] == own[i : i + n]:
                    hit[j : j + n] = True
                    found.add(str(item_id))
    return len(words), int(hit.sum()), sorted(found)


def roots(n, links):
    """The smallest node reachable from each of n nodes."""
    label = list(range(n))

    def root(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i, j in links:
        low, high = sorted((root(int(i)), root(int(j))))
        label[high] = low
    return [root(i) for i in range(n)]
