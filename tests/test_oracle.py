"""Every registered query against its DuckDB oracle (the driver's gate)."""

import re

import pytest

import __spark_entry__ as entry_mod
from chirp.plans.queries import QUERIES as CORE_QUERIES
from tests.compare import compare, duck
from tests.conftest import SF_ORACLE

ORACLE = entry_mod.oracle_sql()
QUERIES = entry_mod.queries()
CORE = set(CORE_QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_oracle_or_is_documented():
    rows_only = {"sentiment_lr", "model_metrics"} | {n for n in QUERIES if re.match(r"op\d+_|pipeline$", n)}
    missing = set(QUERIES) - set(ORACLE) - rows_only
    assert not missing, missing


def test_model_stopwords_are_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover

    from chirp.operators.stopwords import spark_english_stopwords
    assert sorted(spark_english_stopwords()) == sorted(StopWordsRemover.loadDefaultStopWords("english"))


def test_one_failing_part_leaves_the_other_oracles(monkeypatch):
    from chirp.plans import oracle
    monkeypatch.setattr(oracle, "_filtered_tokens", lambda: 1 / 0)
    left = oracle.oracle_queries()
    assert "tfidf" not in left and {"top_mentions", "lexicon_sentiment", "stream_ingest"} <= set(left)


@pytest.mark.parametrize("name", sorted(n for n in ORACLE if n in CORE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_ORACLE)
    ok, msg = compare(df, con, ORACLE[name])
    assert ok, f"{name}: {msg}"


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["retweeted_person", "most_retweeted"]
