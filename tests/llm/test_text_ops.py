"""SimHash, BPE, packing and the classifier against brute force."""

import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chirp.llm import bpe, packing, quality_classifier as C, simhash as H
from chirp.llm.common import components
from chirp.llm.queries import QUERIES
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.helpers import edge_docs, empty_docs

LIB = Tokenizer.from_file(bpe.public_vocabulary())


def simhash_plain(text, k=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    s = [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(x, seed=42) for x in s]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def groups(pairs, nodes):
    low = {n: n for n in nodes}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash_matches_brute_force(spark):
    docs = {r["doc_id"]: simhash_plain(r["text"]) for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    ids = sorted(docs)
    fp = np.array([docs[i] for i in ids], dtype=np.uint64)
    near = [(ids[i], ids[j]) for i in range(len(ids)) for j in i + 1 + np.flatnonzero(np.bitwise_count(fp[i + 1:] ^ fp[i]) <= 2)]
    want = groups(near, ids)
    got = QUERIES["op1_simhash"](spark, SF_ORACLE).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {i: (f"{docs[i]:016x}", want[i]) for i in ids}


@pytest.mark.parametrize("large", [True, False])
def test_links_connect_all_near_fingerprints(spark, large, monkeypatch):
    if large:
        monkeypatch.setattr(H, "PAIRWISE", 2)
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 2 ** 64, 6, dtype=np.uint64)
    fps = {int(s) for s in seeds} | {0}
    for s in seeds.tolist():
        for _ in range(60):
            x = s
            for b in rng.integers(0, 64, rng.integers(1, 4)).tolist():
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    near = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 2]
    want = groups(near, fps)
    got = {r["fp"] % (1 << 64): r["root"] % (1 << 64) for r in H.grouped(df).collect()}
    part = lambda d: sorted(sorted(k for k in d if d[k] == v) for v in set(d.values()))
    assert part(got) == part(want)


def test_components_of_a_long_chain_and_a_hub(spark):
    e = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(
        spark.range(1000, 1500).select(F.lit(999).cast("long"), F.col("id")))
    got = {r["node"]: r["component"] for r in components(e).collect()}
    assert got == {i: 0 for i in range(301)} | {i: 999 for i in range(999, 1500)}
    assert components(e.limit(0)).count() == 0


def test_simhash_edges(spark):
    docs = edge_docs(spark)
    out = H.simhash_dedup(docs).collect()
    assert len(out) == docs.count()
    by = {r["doc_id"]: r for r in out}
    assert by[3]["fingerprint"] == by[4]["fingerprint"] == by[5]["fingerprint"] == "0" * 16
    assert by[3]["component_id"] == by[5]["component_id"] == 3 and by[2]["component_id"] == 1
    assert by[None]["component_id"] is None
    kept = H.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 3, 6, 7, 8, 9, 10] and None in ids
    assert H.simhash_dedup(empty_docs(spark)).count() == 0 and H.keep_one(empty_docs(spark)).count() == 0


def test_bpe_matches_the_library(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").union(edge_docs(spark).select("doc_id", "text"))
    out = bpe.encode_decode(docs).collect()
    rows = docs.collect()
    want = sorted((r["doc_id"] or -1, LIB.encode(r["text"] or "", add_special_tokens=False).ids) for r in rows)
    assert sorted((r["doc_id"] or -1, r["ids"]) for r in out) == want
    assert all(r["n_tokens"] == len(r["ids"]) and r["decoded"] == LIB.decode(r["ids"], skip_special_tokens=False) for r in out)
    assert bpe.encode_decode(empty_docs(spark)).count() == 0


def test_bpe_on_odd_texts():
    enc = bpe.Encoder(bpe.public_vocabulary())
    rng = np.random.default_rng(5)
    odd = ["aaaaaaa" * 9, "abababab" * 99, "İstanbul ΣΑΣ ΟΔΟΣ", "I'm can't 'S '' '' 's", "ﬁ ½ ² ３", "ſ ẞ Ǆ ŉ", "x<|startoftext|>y<|endoftext|>"]
    odd += ["".join(map(chr, rng.integers(32, 0x250, 50))) for _ in range(200)]
    odd += ["".join(map(chr, rng.integers(0x250, 0xd7ff, 30))) for _ in range(100)]
    for t in odd:
        ids = LIB.encode(t, add_special_tokens=False).ids
        assert enc.encode(t) == ids, t
        assert enc.decode(ids) == LIB.decode(ids, skip_special_tokens=False)


def check_packing(out, texts):
    ids = {d: LIB.encode(t or "", add_special_tokens=False).ids + [2] for d, t in texts.items()}
    by_doc, by_seq = {}, {}
    for r in out:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] > 0 and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts, whole in [(by_doc[d], len(ids[d])) for d in ids] + [(p, None) for p in by_seq.values()]:
        at = 0
        for s, n in sorted(parts):
            assert s == at
            at += n
        assert at == whole or (whole is None and at <= 4096)
    return sum(map(len, ids.values())), len(by_seq)


def test_packing(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    total, n = check_packing(QUERIES["op5_packing"](spark, SF_ORACLE).collect(), texts)
    assert 4096 * n <= 1.01 * total + 4096


def test_packing_edges(spark):
    docs = edge_docs(spark).select("doc_id", "text", "h").dropDuplicates(["doc_id"])
    out = packing.pack(docs, with_ids=True).collect()
    check_packing(out, {r["doc_id"]: r["text"] for r in docs.collect()})
    assert all(len(r["ids"]) == r["length"] for r in out)
    twice = packing.pack(docs.union(docs)).groupBy("doc_id", "start").count().filter("count <> 2").count()
    assert twice == 0 and packing.pack(empty_docs(spark)).count() == 0


def test_differencing_balances():
    sizes = np.random.default_rng(0).integers(50, 513, 900)
    w = packing.windows_of(sizes, 4096)
    load = np.bincount(w, sizes)
    assert load.max() <= 4096 and len(load) <= -(-sizes.sum() // 4096) + 2
    assert load.max() - load.min() < 100
    assert packing.windows_of(np.array([4096, 10, 4096]), 4096).tolist() == [0, 2, 1]


def test_classifier_on_held_out_rows(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()}
    out = QUERIES["op9_quality_classifier"](spark, SF_ORACLE).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in out)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in out if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([p == y for p, y in held]) >= 0.95


def test_classifier_edges(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (7, None), (8, 1), (9, 0), (4, 0)], "doc_id long, quality int")
    for lab in (labels, labels.limit(0), labels.filter("quality = 1")):
        out = C.classify(docs, C.fit(docs, lab))
        assert out.count() == docs.count() and set(docs.columns) <= set(out.columns)
        assert all(0 <= r["score"] <= 1 for r in out.collect())
    model = C.fit(docs, labels)
    assert C.classify(empty_docs(spark), model).count() == 0
    plain = C.score_text("one two two", C._Scores(model.weights), model.bias)
    at, weight = C.features("one two two")
    z = model.bias + float(weight @ model.weights[at])
    assert plain == pytest.approx(1 / (1 + np.exp(-z)))
