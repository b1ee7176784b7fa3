import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rankwatch.llm import merkle
from tests.llm.brute import LOWER

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"
NAMES = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    parts = ["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)]
    return h("".join(parts))


def tree(nodes):
    """All levels of a tree, leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([h("".join(row[i : i + 8])) for i in range(0, len(row), 8)])
    return levels


def path(levels, i):
    """(left, right) siblings of leaf i, level by level."""
    out = []
    for row in levels[:-1]:
        a = i - i % 8
        out.append(("".join(row[a:i]), "".join(row[i + 1 : a + 8])))
        i //= 8
    return out


def manifest(rows):
    """Rows of the result, computed with plain lists."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {}
    for lang in langs:
        mine = [(r, leaf(*r)) for r in rows if r[2] == lang]
        own[lang] = sorted(mine, key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = {lang: tree([x for _, x in own[lang]]) for lang in langs}
    top = tree([trees[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, (r, x) in enumerate(own[lang]):
            steps = path(trees[lang], i) + path(top, k)
            shown = x
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                shown = leaf(*r[:4], None if r[4] is None else r[4].translate(LOWER))
            for a, b in steps:
                shown = h(a + shown + b)
            proof = h("".join(a + b for a, b in steps))
            out.append((r[0], x, trees[lang][-1][0], top[-1][0], proof, shown, shown == top[-1][0]))
    return out


def sorted_rows(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def frame(spark, n, langs=("de", "en", None, "éa")):
    rows = []
    for i in range(n):
        text = None if i % 13 == 5 else "" if i % 13 == 6 else f"Some Text {i % 40} É"
        rows.append((i * 7 % 1000, f"s{i % 3}", langs[i % len(langs)], len(text or ""), text))
    return rows


@pytest.mark.parametrize("n, height", [(1, 1), (2, 1), (9, 1), (300, 1), (300, 2), (700, 4)])
def test_equals_plain_trees(spark, n, height):
    rows = frame(spark, n)
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    got = merkle.prove(merkle.build(docs, height))
    assert got.columns == list(NAMES)
    assert sorted_rows(got.collect()) == sorted_rows(manifest(rows))


def test_many_languages_and_one_that_holds_most(spark):
    rows = frame(spark, 600, langs=("xx",)) + frame(spark, 90, langs=tuple(f"l{i}" for i in range(90)))
    got = merkle.prove(merkle.build(spark.createDataFrame(rows, COLUMNS), 1))
    assert sorted_rows(got.collect()) == sorted_rows(manifest(rows))


def test_odd_input(spark):
    same = (5, "s", "de", 3, "ABC")
    rows = [same] * 20 + [(None, None, None, None, None), (None, "s", "de", 1, "x"), (5, "s", "de", 3, "other"),
                          (-3, "s", "de", 0, ""), (7, "s", "", 9, "long " * 50_000)]
    docs = spark.createDataFrame(rows, COLUMNS)
    clash = docs.withColumns({c: F.lit(1) for c in ("g", "leaf", "pos", "n", "part", "place", "block", "path")})
    assert sorted_rows(merkle.prove(merkle.build(clash, 1)).collect()) == sorted_rows(manifest(rows))
    empty = merkle.build(docs.limit(0))
    assert empty.root is None and merkle.prove(empty).collect() == []


def test_whole_proofs_fold_to_the_root(spark):
    rows = frame(spark, 100)
    got = merkle.prove(merkle.build(spark.createDataFrame(rows, COLUMNS), 2), whole=True).collect()
    for r in got:
        assert merkle.fold(r["leaf"], r["proof"]) == r["root"]
        assert h(r["proof"].replace(",", "").replace(";", "")) == r["proof_sha256"]


@pytest.mark.parametrize("levels", [1, 2, 3, 5, 6])
def test_layout_stores_subtrees_together(levels):
    total = (8**levels - 1) // 7
    at = [merkle.addresses(d, np.arange(8**d), levels) for d in range(levels)]
    assert sorted(np.concatenate(at).tolist()) == list(range(total))
    if levels > 1:
        top, below = levels // 2, levels - levels // 2
        size = (8**below - 1) // 7
        for i in (0, 8**top - 1):  # a subtree below the cut is one run of places
            own = np.concatenate([
                merkle.addresses(top + d, np.arange(i * 8**d, (i + 1) * 8**d), levels) for d in range(below)
            ])
            assert own.max() - own.min() + 1 == size == len(own)


def test_query_on_a_whole_table(spark):
    d = "/root/testdata/sf0.01"
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select(*names).collect()]
    got = entry.queries()["op12_merkle_manifest"](spark, d)
    assert sorted_rows(got.collect()) == sorted_rows(manifest(rows))
