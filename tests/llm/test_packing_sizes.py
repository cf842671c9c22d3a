"""Encoding by pieces against the library; groups of very many tiny pieces."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from chirp.llm import packing as P
from chirp.llm.bpe import public_vocabulary
from tests.conftest import SF_SMALL

ODD = ["<|endoftext|> a", "Ünïcode ΣΑΣ 漢字 😀 \x85\xa0\x1c x", "don't we'll 12ab34", "", None, "áb İ ﬁ ²³ ª", "\x00\x01 x", "'S 'T '' !!'t",
       "ÀÖØÞß ÿ¡«»¿–—‘’“”„…€ x’s", "<|pad|", "naïve,café;x1y", " a\n\n b\t", "   ", "it's- 's' a'b x'll!", "foo'd. (foo) \"bar\" a--b", "\x0b a",
       "a" * 5000, "x\n"]


def same(lib, texts):
    for text, ids in zip(texts, lib.texts(pa.array(texts, pa.string()))):
        assert np.frombuffer(ids, "<u4").tolist() == lib.split.library.encode(text or "", add_special_tokens=False).ids, text


def test_ids_equal_the_library(spark, monkeypatch):
    lib = P.LibraryIds(public_vocabulary())
    docs = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect()]
    same(lib, docs + ODD)
    assert lib.texts(pa.array([], pa.string())) == []
    rng = random.Random(2)
    alphabet = "aab'stdrevlm.,!?-\"()0 19 \n\téß漢"
    same(lib, ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)])
    monkeypatch.setattr(P, "CACHE_WORDS", 10)  # forgets between calls
    for start in range(0, 100, 20):
        same(lib, docs[start:start + 20] + ODD)


def test_a_group_of_tiny_pieces_stays_small(spark):
    """Empty texts are one id each: a group is bounded by its pieces too."""
    n = 200_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    out = P.pack(docs).groupBy(F.shiftright("sequence_id", 32).alias("g")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("sequence_id").alias("windows"), F.max("offset").alias("last")).collect()
    assert sum(r.n for r in out) == n and len(out) == -(-n // P.GROUP_PIECES)
    assert all(r.n < 1.1 * P.GROUP_PIECES and r.last < P.CAPACITY for r in out)
    assert sum(r.windows for r in out) <= n // P.CAPACITY + 2 * len(out)
    tracemalloc.start()
    P.windows_of(np.full(P.GROUP_PIECES, 32), P.CAPACITY)   # as many pieces and windows as a group has
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400_000_000
