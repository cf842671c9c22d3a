"""Golden edge cases for the column functions and cleaning."""

import datetime as dt

from pyspark.sql import functions as F

from chirp.functions import (clean_text, created_at_parts, first_mention,
                             polarity_label, strip_offset, subjectivity_label)
from chirp.operators.clean import clean_tweets, delete_where, null_profile
from chirp.schemas import CLEAN_ADDED, RAW_COLUMNS, RAW_TWEET


def one_col(spark, values, ddl="s string"):
    return spark.createDataFrame([(v,) for v in values], ddl)


def test_first_mention_forms(spark):
    df = one_col(spark, ["RT @A: x", "hi @B!", "@@c", "x @", "no mention", None, "a@b.com x"])
    got = [r[0] for r in df.select(first_mention("s")).collect()]
    assert got == ["a", "b!", "", "", "", None, "b.com"]


def test_first_mention_only_retweets(spark):
    df = one_col(spark, ["RT @A: x", "hi @B!"])
    got = [r[0] for r in df.select(first_mention("s", only_retweets=True)).collect()]
    assert got == ["a", ""]


def test_clean_text_example(spark):
    df = one_col(spark, ["RT @A: See http://t.co/x #Big_Deal [ok]", None, "  ", "Ünïcode\tand\nlines"])
    got = [r[0] for r in df.select(clean_text("s")).collect()]
    assert got == ["a see big_deal [ok]", None, "", "n code and lines"]


def test_clean_text_strict_drops_brackets(spark):
    got = one_col(spark, ["a[b]_c^d"]).select(clean_text("s", strict=True)).first()[0]
    assert got == "a b c d"


def test_clean_text_matches_four_step_chain(spark):
    """The fused regex equals the reference's four separate passes."""
    from hypothesis import given, settings, strategies as st
    alphabet = st.sampled_from(list("aZ09@ _[]^`\\#:.,!\t\n\r éü") + ["RT @", "http://x.y/z", "http"])
    samples = []

    @settings(max_examples=300, database=None)
    @given(st.lists(alphabet, max_size=30).map("".join))
    def collect(s):
        samples.append(s)

    collect()
    df = one_col(spark, samples)
    chain = F.trim(F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        F.regexp_replace("s", "RT @", ""), r"http\S+", ""), "[^a-zA-z0-9@]", " "), r"\s+", " ")))
    bad = df.filter(~clean_text("s").eqNullSafe(chain)).count()
    assert bad == 0


def test_clean_text_idempotent(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(clean_text("text").alias("c"))
    assert df.filter(clean_text("c") != F.col("c")).count() == 0


def test_created_at_parts(spark):
    df = one_col(spark, ["Sat May 07 12:34:56 +0000 2022", "garbage", None])
    cols = created_at_parts(strip_offset("s"))
    rows = df.select(*[v.alias(k) for k, v in cols.items()]).collect()
    r = rows[0]
    assert (r.day_of_week, r.month_name, r.month, r.day, r.hour, r.minute, r.second, r.year) == \
        ("Sat", "May", "05", "07", "12", "34", "56", "2022")
    assert r.tweet_date_string == "2022-05-07" and r.tweet_time_string == "12:34:56"
    assert r.tweet_date == dt.datetime(2022, 5, 7, 12, 34, 56)
    assert rows[1].tweet_date is None and rows[1].month is None
    assert rows[2].tweet_date is None


def test_buckets(spark):
    p = spark.createDataFrame([(x,) for x in [-1.0, -0.5, -0.1, 0.0, 0.6, 0.61]], "p double")
    assert [r[0] for r in p.select(polarity_label("p")).collect()] == \
        ["Very Negative", "Negative", "Negative", "Neutral", "Positive", "Very Positive"]
    s = spark.createDataFrame([(x,) for x in [0.0, 0.4, 0.6, 1.0]], "s double")
    assert [r[0] for r in s.select(subjectivity_label("s")).collect()] == \
        ["Objective", "Neutral", "Subjective", "Subjective"]


def test_clean_tweets_schema_and_delete(spark):
    row = [1, "n", "sn", "True", "loc", 2, 3, "RT @X: hi", 0, 0,
           "Sat May 07 12:34:56 +0000 2022", None, "", "", "", "", ""]
    null_row = [2] + row[1:7] + [None] + row[8:]
    df = spark.createDataFrame([row, null_row], RAW_TWEET)
    out = clean_tweets(df)
    assert out.columns == RAW_COLUMNS + CLEAN_ADDED
    assert out.first().created_at == "Sat May 07 12:34:56   2022"
    prof = null_profile(out).first()
    assert (prof.n_rows, prof.null_tweets, prof.non_null_tweets) == (2, 1, 1)
    assert delete_where(out, F.col("tweet").isNull()).count() == 1
