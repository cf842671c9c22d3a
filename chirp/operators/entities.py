"""Mentions, hashtags and media URLs: token tables, top-k reports and
word-cloud term weights (B09-B12, C01, D03-D05, D11, E10-E12, F01-F03).

The reference collected these columns to the driver and concatenated
lists there; here each report is one plan:
scan -> filter -> explode -> partial agg -> exchange -> final agg -> top-k.
Partial aggregation collapses a hot token inside every map task, so a
token holding a third of all rows costs one row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chirp.operators.stopwords import HANDLE_STOPWORDS


def stopword_frame(spark: SparkSession, words: Iterable[str],
                   col: str = "word") -> DataFrame:
    """A small fixed lookup table (size bounded by the list itself)."""
    return spark.createDataFrame([(w,) for w in sorted(set(words))], f"{col} string")


def mention_tokens(clean: DataFrame,
                   stopwords: Iterable[str] | None = None) -> DataFrame:
    """Handles without stopwords and blanks; a NULL handle is kept.

    Anti-join against the broadcast stopword list (a fixed, bounded
    table), so a NULL key survives as it does with ``not in`` on a Python
    list; then the blank filter, which also keeps NULL.
    """
    words = HANDLE_STOPWORDS if stopwords is None else list(stopwords)
    spark = clean.sparkSession
    sw = stopword_frame(spark, words, "retweeted_person")
    handles = clean.select("retweeted_person")
    kept = handles.join(F.broadcast(sw), "retweeted_person", "left_anti")
    return kept.filter(F.col("retweeted_person").isNull()
                       | (F.col("retweeted_person") != ""))


def hashtag_tokens(df: DataFrame, col: str = "hashtags_and_media",
                   normalize: bool = False) -> DataFrame:
    """One row per space-separated token of fields containing ``#``.

    Tokens are case-sensitive and not filtered (empty tokens from double
    spaces count too); ``normalize`` lower-cases and drops blanks.
    """
    src = df.filter(F.col(col).isNotNull() & (F.instr(col, "#") > 0))
    out = src.select(F.explode(F.split(col, " ")).alias("hashtags"))
    if normalize:
        out = (out.select(F.lower("hashtags").alias("hashtags"))
               .filter(F.trim("hashtags") != ""))
    return out


def media_tokens(df: DataFrame, col: str = "hashtags_and_media") -> DataFrame:
    """URLs from the media field: split on spaces, keep tokens that contain
    ``http`` (so both the media URL and the short link of every item),
    drop all commas. The type token is dropped by the ``http`` test."""
    src = df.filter(F.col(col).isNotNull() & (F.instr(col, "http") > 0))
    tok = src.select(F.explode(F.split(col, " ")).alias("media_url"))
    tok = tok.filter(F.col("media_url").isNotNull()
                     & (F.trim("media_url") != "")
                     & (F.instr("media_url", "http") > 0))
    return tok.select(F.replace("media_url", F.lit(","), F.lit("")).alias("media_url"))


def top_k(tokens: DataFrame, key: str, k: int, count_alias: str,
          count_first: bool = False) -> DataFrame:
    """``SELECT key, count(key) AS n ... GROUP BY key ORDER BY n DESC
    LIMIT k`` with the key as tie-break (ascending, NULLs last), so the
    cut is deterministic. Plans as HashAggregate x2 + TakeOrderedAndProject.
    """
    counts = tokens.groupBy(key).agg(F.count(key).alias(count_alias))
    top = counts.orderBy(F.col(count_alias).desc(), F.col(key).asc_nulls_last()).limit(k)
    return top.select(count_alias, key) if count_first else top


def most_retweeted(clean: DataFrame, k: int = 50) -> DataFrame:
    return top_k(mention_tokens(clean), "retweeted_person", k, "most_retweeted")


def most_hashtags(df: DataFrame, k: int = 50) -> DataFrame:
    return top_k(hashtag_tokens(df), "hashtags", k, "most_hashtags")


def most_media(df: DataFrame, k: int = 20) -> DataFrame:
    return top_k(media_tokens(df), "media_url", k, "most_media", count_first=True)


def term_weights(tokens: DataFrame, col: str, max_terms: int = 200,
                 split_words: bool = True) -> DataFrame:
    """Data behind a word cloud: the ``max_terms`` most frequent terms with
    their count and weight ``n / max(n)``.

    Terms are the space-separated words of ``col`` (blank words dropped).
    The weight window runs over the top-k output only (at most
    ``max_terms`` rows), never over the token table.
    """
    words = (tokens.select(F.explode(F.split(col, " ")).alias("term")) if split_words
             else tokens.select(F.col(col).alias("term")))
    words = words.filter(F.col("term").isNotNull() & (F.col("term") != ""))
    counts = words.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.col("n").desc(), F.col("term").asc()).limit(max_terms)
    w = Window.partitionBy()  # bounded: at most max_terms rows
    return top.select("term", "n", (F.col("n") / F.max("n").over(w)).alias("weight"))
