"""Merkle manifest against a plain tree in Python."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from chirp.llm import merkle as M
from chirp.llm import queries as LQ
from tests.compare import compare, duck
from tests.conftest import SF_ORACLE
from tests.llm.helpers import edge_docs, empty_docs

LOWER = str.maketrans(M.UPPER, M.UPPER.lower())


def h(text):
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return h("".join("-" if v is None else f"{len(str(v).encode('utf-8'))}:{v}" for v in values))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def way(levels, i):
    out = []
    for nodes in levels[:-1]:
        s = i - i % 8
        out.append(("".join(nodes[s:i]), "".join(nodes[i + 1:s + 8])))
        i //= 8
    return out


def expected(rows):
    """Sorted (doc_id, leaf, subroot, root, proof, folded, verified)."""
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r["lang"]].append(r)
    for group in by_lang.values():
        group.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    trees = {lang: tree([leaf(r, r["text"]) for r in g]) for lang, g in by_lang.items()}
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode("utf-8")))
    top = tree([trees[x][-1][0] for x in order])
    out = []
    for n, lang in enumerate(order):
        for i, r in enumerate(by_lang[lang]):
            path = way(trees[lang], i) + way(top, n)
            changed = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            folded = leaf(r, r["text"].translate(LOWER) if changed and r["text"] is not None else r["text"])
            for left, right in path:
                folded = h(left + folded + right)
            out.append((r["doc_id"], leaf(r, r["text"]), trees[lang][-1][0], top[-1][0],
                        h("".join(a + b for a, b in path)), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                               "verified").collect()), key=repr)


def test_query_equals_its_sql(spark):
    ok, msg = compare(LQ.op11_merkle(spark, SF_ORACLE), duck(SF_ORACLE), LQ.OP11_SQL)
    assert ok, msg


def test_edges(spark):
    docs = edge_docs(spark)
    assert got(M.merkle_manifest(docs)) == expected(docs.collect())
    assert M.merkle_manifest(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("size", [1, 2, 8, 9, 65, 513, 1300])
def test_one_group_of_any_size_with_a_hot_id(spark, size):
    """A single group (and the last run of one node), a third of the rows equal."""
    rows = [(i if i % 3 else 0, f"Text {i if i % 3 else 0}", "en", "s", 5) for i in range(size)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    assert got(M.merkle_manifest(docs)) == expected(docs.collect())


def test_many_groups_and_deep_trees(spark):
    """Blocks of one level: four rounds, more groups than a block holds."""
    rows = [(i, f"Text {i}", None if i % 70 == 0 else f"l{i % 70}" if i % 2 else "hot", "s", i) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert got(M.merkle_manifest(docs, height=1)) == expected(docs.collect())


def test_a_version_copies_only_the_ancestors_of_its_leaf(spark):
    """The copied nodes of a version are those of the tree built anew with
    the changed leaf; all others are nodes of the original tree."""
    rows = [(i, f"Text {i}", "en", "s", 1) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r["doc_id"]: r["copied_nodes"] for r in M.merkle_manifest(docs).collect()}
    by_id = sorted(docs.collect(), key=lambda r: r["doc_id"])
    base = tree([leaf(r, r["text"]) for r in by_id])
    for i in (7, 64, 599):
        changed = zlib.crc32(str(i).encode()) % 3 == 0
        assert (out[i] is not None) == changed
    for i in [i for i in range(600) if out[i] is not None][:5]:
        new = tree([leaf(r, r["text"].translate(LOWER)) if r["doc_id"] == i else x for r, x in zip(by_id, base[0])])
        differing = [b for old, now in zip(base[1:], new[1:]) for a, b in zip(old, now) if a != b]
        assert out[i] == differing


def test_texts_are_read_once_and_not_shuffled(spark):
    plan = M.merkle_manifest(spark.read.parquet(f"{SF_ORACLE}/documents.parquet"))._jdf.queryExecution().toString()
    assert "text#" not in plan
