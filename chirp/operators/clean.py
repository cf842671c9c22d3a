"""Tweet cleaning (B02, B07, B08, D01, D02, A19 as a filter)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirp.functions.text import clean_text, first_mention
from chirp.functions.timeparts import created_at_parts, strip_offset
from chirp.sources.tables import delete_where


def clean_tweets(df: DataFrame, strict: bool = False,
                 only_retweets: bool = False, arrow: bool = False) -> DataFrame:
    """Append the 13 derived columns of the clean table to a raw tweet
    table and rewrite ``created_at`` (offset -> one space).

    One projection: Catalyst fuses it with the scan in a single
    whole-stage-codegen stage, no shuffle. ``arrow`` cleans the text in Arrow
    batches (see ``clean_text``).
    """
    ca = strip_offset("created_at")
    cols = {
        "retweeted_person": first_mention("tweet", only_retweets=only_retweets),
        "tweet_parse": clean_text("tweet", strict=strict, arrow=arrow),
        "created_at": ca,
    }
    cols.update(created_at_parts(ca))
    return df.withColumns(cols)


def drop_null_tweets(df: DataFrame, drop_empty: bool = False) -> DataFrame:
    """``DELETE ... WHERE tweet IS NULL``; ``drop_empty`` also removes rows
    whose cleaned text is empty."""
    out = delete_where(df, F.col("tweet").isNull())
    if drop_empty:
        out = delete_where(out, F.col("tweet_parse") == "")
    return out


def null_profile(df: DataFrame, text: str = "tweet",
                 parsed: str | None = "tweet_parse") -> DataFrame:
    """One pass: rows, NULL texts, non-NULL texts (and empty cleaned
    texts). Partial aggregation on every task, one tiny exchange."""
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(text).isNull()).alias("null_tweets"),
            F.count_if(F.col(text).isNotNull()).alias("non_null_tweets")]
    if parsed:
        aggs.append(F.count_if(F.col(parsed) == "").alias("empty_parse"))
    return df.agg(*aggs)
