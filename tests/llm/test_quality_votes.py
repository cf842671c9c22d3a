"""Quality rules: clean documents that one vote used to reject."""

import random

from chirp.llm import quality_rules as Q
from chirp.llm.queries import QUERIES
from tests.conftest import SF_ORACLE


def test_some_repetition_does_not_reject_a_clean_document(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()}
    out = QUERIES["op4_quality_rules"](spark, SF_ORACLE).collect()
    some = [r for r in out if labels.get(r["doc_id"]) == 1 and 10 < 100 * r["n_repeat_words"] / max(r["n_words"], 1) <= 20]
    assert some and all(r["kept"] for r in some if not r["base_failed"])


def test_vocabulary_vote_does_not_depend_on_length(spark):
    rng = random.Random(3)
    known = [f"word{i}" for i in range(600)]
    prose = lambda n: " ".join(rng.choice(known) for _ in range(n))
    docs = [(1, prose(100)), (2, prose(4000)), (3, " ".join(rng.choice(known[:12]) for _ in range(4000)))]
    out = {r["doc_id"]: r for r in Q.with_features(spark.createDataFrame(docs, "doc_id long, text string"))
           .select("*", *Q.votes()).collect()}
    assert [out[i]["vote_vocabulary"] for i in (1, 2, 3)] == [1, 1, -1]
    words = docs[1][1].split()
    assert out[2]["n_block_distinct"] == sum(len(set(words[i:i + 100])) for i in range(0, 4000, 100))


def test_good_votes_outweigh_a_bad_one(spark):
    """The verdict is the posterior's: of the documents that pass the base
    rules, some with one bad vote stay, and those with several go."""
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    out = [r for r in Q.quality_rules(docs, keep=["doc_id"]).collect() if not r["base_failed"]]
    bad = lambda r: sum(r[f"vote_{k}"] < 0 for k in Q.RULES)
    one = [r for r in out if bad(r) == 1]
    assert any(r["kept"] for r in one)
    assert not any(r["kept"] for r in out if bad(r) >= 3) and any(bad(r) >= 3 for r in out)
    assert all(r["kept"] for r in out if bad(r) == 0 and sum(r[f"vote_{k}"] > 0 for k in Q.RULES) >= 3)


def test_rate_features_against_python(spark):
    texts = ["The cat sat. It is 3 o'clock!", "a | b | 12 -- c?! $$$ end", "", " \n\t", "UND die Katze", "x.\n"]
    out = [tuple(r) for r in Q.with_features(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
           .orderBy("doc_id").select("n_function_words", "n_ends", "n_punct_runs", "n_bare").collect()]
    assert out == [(3, 2, 0, 1), (1, 1, 3, 5), (0, 0, 0, 0), (0, 0, 0, 0), (1, 0, 0, 0), (0, 1, 0, 0)]
