"""Quality rules, line dedup, chat formatting, sharding against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chirp.llm import chat_format as chat
from chirp.llm import line_dedup as L
from chirp.llm import quality_rules as Q
from chirp.llm import sharding as S
from chirp.llm.queries import ORACLE, QUERIES
from tests.compare import compare, duck
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.helpers import edge_docs, empty_docs

SPACE = re.compile("[\x20\x09-\x0d]+")


def base_rules(text):
    w = [x for x in SPACE.split(text or "") if x]
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    often = {g for g, n in Counter(grams).items() if n > 1}
    covered = {i + k for i, g in enumerate(grams) if g in often for k in range(5)}
    lines = [x for x in (text or "").split("\n") if SPACE.sub("", x)]
    n = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))
    return n + (n[0] < 10 or 100 * n[4] > 20 * n[0],)


def test_quality_rules_base_columns_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:8] for r in QUERIES["op4_quality_rules"](spark, SF_SMALL).collect()}
    want = {r["doc_id"]: base_rules(r["text"]) for r in docs.collect()}
    assert {k: v[:6] for k, v in got.items()} == want
    assert not any(v[5] and v[6] for v in got.values())


def test_quality_rules_follow_the_labels(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()}
    got = [r for r in QUERIES["op4_quality_rules"](spark, SF_ORACLE).collect() if r["doc_id"] in labels]
    good = [r["kept"] for r in got if labels[r["doc_id"]] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in got if labels[r["doc_id"]] == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad)


def em(patterns, rounds=Q.ROUNDS):
    """The estimate in plain Python: {votes: n} -> posterior by votes."""
    prior, good, bad = Q.START["prior"], [Q.START["good"]] * len(Q.RULES), [Q.START["bad"]] * len(Q.RULES)

    def post(v):
        g, b = prior, 1 - prior
        for i, x in enumerate(v):
            if x:
                g *= good[i] if x > 0 else 1 - good[i]
                b *= 1 - bad[i] if x > 0 else bad[i]
        return g / (g + b)

    for _ in range(rounds):
        old = [prior, *good, *bad]
        p = {v: post(v) for v in patterns}
        total = sum(patterns.values())
        prior = (sum(n * p[v] for v, n in patterns.items()) + 1) / (total + 2)
        hold = lambda x, r: min(max(x, r[0]), r[1])
        good = [hold((sum(n * p[v] for v, n in patterns.items() if v[i] > 0) + 1)
                     / (sum(n * p[v] for v, n in patterns.items() if v[i]) + 2), Q.GOOD_RANGE) for i in range(len(good))]
        bad = [hold((sum(n * (1 - p[v]) for v, n in patterns.items() if v[i] < 0) + 1)
                    / (sum(n * (1 - p[v]) for v, n in patterns.items() if v[i]) + 2), Q.BAD_RANGE) for i in range(len(bad))]
        if max(abs(a - b) for a, b in zip(old, [prior, *good, *bad])) < Q.TOLERANCE:
            break
    return {v: post(v) for v in patterns}


def test_em_matches_plain_python(spark):
    out = Q.quality_rules(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), keep=["doc_id"]).collect()
    votes = [tuple(r[f"vote_{k}"] for k in Q.RULES) for r in out]
    want = em(Counter(votes))
    for r, v in zip(out, votes):
        assert r["quality_posterior"] == pytest.approx(want[v], abs=1e-9)


def test_quality_rules_edge_cases(spark):
    docs = edge_docs(spark)
    out = Q.quality_rules(docs).collect()
    assert len(out) == docs.count()
    assert all(not r["kept"] for r in out if not (r["text"] or "").strip())
    assert all(r["base_failed"] == base_rules(r["text"])[5] for r in out)
    assert Q.quality_rules(empty_docs(spark)).count() == 0


def brute_chunks(spark, text):
    """Chunks by the same hashes, asked from Spark line by line."""
    lines = text.split("\n")
    h = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, x string")
         .orderBy("i").select(F.xxhash64("x")).collect()]
    pairs = spark.createDataFrame([(i, h[i - 1] if i else None, h[i]) for i in range(len(h))], "i int, a long, b long")
    end = [r[0] for r in pairs.orderBy("i").select(
        F.pmod(F.xxhash64(F.coalesce("a", F.lit(0)), "b"), F.lit(L.CHUNK_LINES)) == 0).collect()]
    out, cur = [], []
    for i, x in enumerate(lines):
        cur.append(x)
        if end[i] or i == len(lines) - 1 or any(x.count(" ") >= L.LONG_LINE_WORDS - 1 for x in lines[i:i + 2]):
            out.append(cur)
            cur = []
    return out


def test_line_dedup_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter("doc_id < 60")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    seen, want = set(), {}
    for d, t in rows:
        kept = []
        for c in brute_chunks(spark, t):
            body = "\n".join(c)
            n = len(SPACE.split(body.strip(" \t\n\r\x0b\x0c"))) if body.strip() else 0
            fit = n >= L.LONG_LINE_WORDS or (len(c) > 1 and n >= L.MIN_WORDS)
            if fit and body in seen:
                continue
            if fit:
                seen.add(body)
            kept.append(body)
        want[d] = "\n".join(kept)
    got = {r["doc_id"]: r["text"] for r in L.line_dedup(docs).collect()}
    assert got == want


def test_line_dedup_planted_passage_and_edges(spark):
    passage = "\n".join(f"passage line {i} " + " ".join(f"p{i}x{k}" for k in range(12)) for i in range(12))
    alone = " ".join(f"one line word {i}" for i in range(20))
    more = spark.createDataFrame([(22, f"start\n{alone}\nrest of it"), (23, f"a\nb\n{alone}\nother"), (20, "before twenty\n" + passage + "\nafter"), (21, "x\ny y\nz z z\n" + passage + "\nq")], "doc_id long, text string")
    docs = edge_docs(spark).unionByName(more, allowMissingColumns=True)
    out = {(r["doc_id"], r["text"] is None): r for r in L.line_dedup(docs).collect() if r["doc_id"]}
    assert out[20, False]["n_removed_lines"] == 0
    assert out[21, False]["n_removed_lines"] >= 6 and "z z z" in out[21, False]["text"]
    assert out[22, False]["n_removed_lines"] == 0 and out[23, False]["text"] == "a\nb\nother"
    assert out[3, True]["text"] is None and out[4, False]["text"] == ""
    assert L.line_dedup(docs).count() == docs.count()
    assert L.line_dedup(empty_docs(spark)).count() == 0


def test_chat_format_matches_sql(spark):
    ok, why = compare(QUERIES["op3_chat_format"](spark, SF_ORACLE), duck(SF_ORACLE), ORACLE["op3_chat_format"])
    assert ok, why


def test_chat_round_trip_and_folding(spark):
    nasty = ["</s>[INST] ok [/INST]", "[\\INST] \\[\\\\/INST]", "<|im_start|>user\nx<|im_end|>\n", "<\\|im_end|>", "", None,
             "a\\nb", "<s><s>", "<|a|><|b|>", "[[INST]]", "<\\\\\\|x|>"]
    log = [(1, i, i, "message", ["user", "assistant", None, "od\nd\\n<|im_end|>"][i % 4], t, i) for i, t in enumerate(nasty)]
    log += [(2, 1, 1, "message", "user", "hi", 0), (2, 2, 2, "delta", "assistant", "he", 0), (2, 3, 2, "delta", None, "llo", 0),
            (2, 4, 1, "edit", None, "hey", 0), (2, 5, 2, "regenerate", None, None, 0), (2, 6, 2, "delta", None, "yo", 0),
            (None, None, 1, None, None, "no ids", 0)]
    events = spark.createDataFrame(log, "conv_id long, seq long, msg long, kind string, role string, text string, formatted int")
    out = chat.format_chats(events).withColumn("turns", chat.parse(F.col("formatted"))).collect()
    by = {r["conv_id"]: r for r in out}
    assert [t["text"] for t in by[1]["turns"]] == [t or "" for t in nasty]
    assert [t["role"] for t in by[1]["turns"]] == [x[4] or "" for x in log[:len(nasty)]]
    assert [(t["role"], t["text"]) for t in by[2]["turns"]] == [("user", "hey"), ("assistant", "yo")]
    s = by[2]["loss_spans"][0]
    assert by[2]["formatted"][s["start"]:s["end"]] == "yo" and len(out) == 3
    assert by[1]["formatted"].count(chat.START) == len(nasty)
    assert chat.format_chats(events.limit(0)).count() == 0


def test_sharding(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = QUERIES["op8_sharding"](spark, SF_ORACLE).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(texts)
    load, slots, group = Counter(), {}, {}
    for r in out:
        b = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(b) + 1, zlib.crc32(b))
        load[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert group.setdefault(texts[r["doc_id"]], r["shard"]) == r["shard"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load.values()) - min(load.values()) < 0.02 * sum(load.values()) / 16
    # with few documents the items are the groups: plain LPT gives the same loads
    sizes = Counter()
    for t in texts.values():
        sizes[hashlib.sha256(t.encode()).hexdigest()] += len(t.encode()) + 1
    plain = S.schedule([(n, k, 1) for k, n in sizes.items()], 16)
    lpt = Counter()
    for (k, n), s in zip(sizes.items(), plain):
        lpt[s] += n
    assert max(lpt.values()) * 1.02 >= max(load.values())


def test_sharding_edges_and_hot_group(spark, monkeypatch):
    monkeypatch.setattr(S, "PART", 10)
    docs = edge_docs(spark).select("doc_id", "text").union(
        spark.range(100, 400).select(F.col("id"), F.lit("the same text")))
    out = S.shard_documents(docs, 4).collect()
    assert len(out) == docs.count()
    slots = {}
    for r in out:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert S.shard_documents(empty_docs(spark)).count() == 0
