"""Embedding near-dedup, licence scan and the pipeline."""

import numpy as np
import pytest

import corpus_pipeline as P
from chirp.llm import embedding_dedup as G
from chirp.llm import license_scan as LS
from chirp.llm import queries as LQ
from chirp.llm import simhash as H
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.helpers import edge_docs, empty_docs
from tests.llm.test_text_ops import check_packing, groups


def brute(rows, threshold=0.93):
    ok = [(i, np.array(v, float), l) for i, v, l in rows
          if l is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    pairs = []
    for k, (i, v, l) in enumerate(ok):
        for j, w, m in ok[:k]:
            if l == m and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= threshold:
                pairs.append((i, j))
    links = {i: 0 for i, *_ in rows}
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    return links, groups(pairs, [i for i, *_ in rows])


@pytest.mark.parametrize("shard_rows", [G.SHARD_ROWS, 40])
def test_embedding_links_against_brute_force(spark, shard_rows, monkeypatch):
    monkeypatch.setattr(G, "SHARD_ROWS", shard_rows)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    links, comp = brute(rows)
    got = {r["vec_id"]: r for r in LQ.op7_embedding_dedup(spark, SF_ORACLE).collect()}
    assert len(got) == len(rows)
    found = sum(min(got[i]["n_links"], n) for i, n in links.items())
    assert all(got[i]["n_links"] <= n for i, n in links.items())
    assert found >= 0.95 * sum(links.values())
    if found == sum(links.values()):
        assert {i: r["component_id"] for i, r in got.items()} == comp
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_embedding_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1, 0), (2, [1.0, 0.0], 1, 0), (3, [2.0, 0.1], 1, 0), (4, [1.0, 0.0], 2, 0), (5, [1.0, 0.0], None, 0),
            (6, None, 1, 0), (7, [0.0, 0.0], 1, 0), (8, [nan, 1.0], 1, 0), (9, [1.0, inf], 1, 0), (10, [1.0, None], 1, 0),
            (11, [], 1, 0), (12, [1.0], 1, 0), (None, [0.0, 1.0], 1, 0), (13, [1.0, 0.0], 1, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n_links int")
    got = {r["vec_id"]: tuple(r)[1:] for r in G.embedding_dedup(df).collect()}
    assert got[1] == (3, 1, True) and got[2] == (3, 1, False) and got[3] == (3, 1, False) and got[13] == (3, 1, False)
    assert all(got[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12)) and got[None] == (0, None, True)
    assert G.embedding_dedup(df.limit(0)).count() == 0


def test_license_scan_finds_declared_licenses(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    notices = {t: f for f, ts in LS.TEMPLATES.items() for t in ts}
    want = {r["doc_id"]: sorted({notices[x] for x in r["text"].split("\n") if x in notices}) for r in docs.collect()}
    got = {r["doc_id"]: r["families"] for r in LQ.op2_license_scan(spark, SF_ORACLE).collect()}
    assert got == want and any(got.values())


def test_license_scan_edges(spark):
    more = spark.createDataFrame([
        (30, "You need a licence to drive.\nAll the rights of the members were reserved for later."),
        (31, "some words\nThis file is licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
             "except in compliance with the License.\nmore words"),
        (32, "Copyright 2020. All rights reserved.")], "doc_id long, text string")
    docs = edge_docs(spark).unionByName(more, allowMissingColumns=True)
    out = {r["doc_id"]: r for r in LS.license_scan(docs).collect()}
    assert out[31]["families"] == ["Apache-2.0"] and out[31]["found"][0]["paragraph"] == 1
    assert out[32]["families"] == ["proprietary"]
    assert all(not r["families"] for i, r in out.items() if i not in (31, 32))
    assert LS.license_scan(empty_docs(spark)).count() == 0


def test_pipeline_stages(spark):
    """Each stage on what the one before kept; the last against its texts."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality_rules", "quality_classifier", "line_dedup", "simhash_dedup", "packing"]
    for name, stage in P.STAGES[:-1]:
        before = docs
        docs = P.stored(stage(spark, before, SF_SMALL), f"test_{name}")
        assert docs.columns == before.columns
        if name == "line_dedup":
            assert docs.count() == before.count()
        if name == "simhash_dedup":
            parts = H.simhash_dedup(before).select("component_id").distinct().count()
            assert docs.count() == parts
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    last = P.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    check_packing(last, texts)
    assert len(P.run(spark, SF_SMALL).collect()) == len(last)


def test_pipeline_on_edges(spark):
    docs = edge_docs(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for d in (docs, docs.limit(0)):
        for _, stage in P.STAGES:
            assert stage(spark, d, SF_SMALL).count() >= 0


def test_license_scan_finds_wrapped_and_several(spark):
    """Every template wrapped at 60 columns between paragraphs, dual and
    variant identifiers, and texts that only look alike."""
    import textwrap
    prose = "the river runs past the old mill and the houses of the village near the hill\n"
    rows, want = [], []
    for family, notices in LS.TEMPLATES.items():
        for t in notices:
            if " OR " in t:  # declares two
                continue
            rows.append(prose * 3 + "\n" + "\n".join(textwrap.wrap(t, 60)) + "\n \n" + prose * 2)
            want.append([family])
    for line, families in (("SPDX-License-Identifier: GPL-3.0-only", ["GPL-3.0"]), ("SPDX-License-Identifier: BSD-2-Clause", ["BSD"]),
                           ("SPDX-License-Identifier: LGPL-3.0-or-later", ["LGPL"]),
                           ("SPDX-License-Identifier: MIT OR Apache-2.0", ["Apache-2.0", "MIT"]),
                           ("Released under the MIT License.\n" + prose * 400, ["MIT"]),
                           ("All rights\n\nreserved.", []), (prose * 50, [])):
        rows.append(line)
        want.append(families)
    out = {r["doc_id"]: r for r in LS.license_scan(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    wrong = [(i, rows[i][:300], want[i], out[i]["families"]) for i in out if not set(want[i]) <= set(out[i]["families"])]
    extra = [(i, want[i], out[i]["families"]) for i in out if len(out[i]["families"]) > max(len(want[i]), 1) or not want[i] and out[i]["families"]]
    print(wrong, extra)
    assert not wrong and not extra
    assert all(r["n_licenses"] == len(r["families"]) for r in out.values())
