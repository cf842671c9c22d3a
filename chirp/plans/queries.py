"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
over the whole shared tables. Column names match chirp.plans.oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from chirp.functions.text import clean_text as clean_text_expr
from chirp.functions.text import flatten_newlines
from chirp.operators import clean as C
from chirp.operators import entities as E
from chirp.operators import prediction as P
from chirp.operators import sentiment as S
from chirp.plans.tables import load
from chirp.plans.tweet_view import tweet_event_lines, tweet_events, tweet_view
from chirp.session import scratch_path, shuffles_freed, stored
from chirp.sources import json_tweets as J
from chirp.sources import tables as T
from chirp.sources import tsv as V
from chirp.streaming import ingest as S_in
from chirp.schemas import CLEAN_ADDED, RAW_TWEET

Query = Callable[[SparkSession, str], DataFrame]


def clean_view(spark: SparkSession, sf_dir: str, arrow: bool = False) -> DataFrame:
    return C.clean_tweets(tweet_view(spark, sf_dir), arrow=arrow)


def first_mention(spark, sf_dir):
    return clean_view(spark, sf_dir).select("tweetid", "retweeted_person")


def clean_text(spark, sf_dir):
    return clean_view(spark, sf_dir).select("tweetid", "tweet_parse")


def time_parts(spark, sf_dir):
    cols = ["tweetid", "created_at"] + [c for c in CLEAN_ADDED
                                        if c not in ("retweeted_person", "tweet_parse")]
    return clean_view(spark, sf_dir).select(*cols)


def null_profile(spark, sf_dir):
    return C.null_profile(clean_view(spark, sf_dir))


def drop_null_tweets(spark, sf_dir):
    return C.drop_null_tweets(clean_view(spark, sf_dir)).select(
        "tweetid", "retweeted_person", "tweet_parse")


def top_mentions(spark, sf_dir):
    return E.most_retweeted(clean_view(spark, sf_dir), 50)


def top_hashtags(spark, sf_dir):
    return E.most_hashtags(tweet_view(spark, sf_dir), 50)


def top_media(spark, sf_dir):
    return E.most_media(tweet_view(spark, sf_dir), 20)


def term_weights(spark, sf_dir):
    return E.term_weights(E.mention_tokens(clean_view(spark, sf_dir)), "retweeted_person", 200)


def sentiments(spark, sf_dir, arrow=False):
    """Stage 7: sentiment table (with its tweet id) over non-NULL tweets.
    ``arrow``: texts cleaned in Arrow batches, for what counts terms there."""
    clean = C.drop_null_tweets(clean_view(spark, sf_dir, arrow))
    return S.sentiment_table(clean, keep_key=True)


def lexicon_sentiment(spark, sf_dir):
    clean = C.drop_null_tweets(clean_view(spark, sf_dir))
    return S.score_sentiment(clean, "tweet_parse").select("tweetid", "polarity", "subjectivity")


def lexicon_sentiment_join(spark, sf_dir):
    """The same scores with the lexicon as a table."""
    clean = C.drop_null_tweets(clean_view(spark, sf_dir)).select("tweetid", "tweet_parse")
    scored = S.score_sentiment(clean, "tweet_parse", S.lexicon_frame(spark), "join", "tweetid")
    return scored.select("tweetid", "polarity", "subjectivity")


def sentiment_scorer(spark, sf_dir):
    """The same scores by a user's scorer, an Arrow-batched function."""
    clean = C.drop_null_tweets(clean_view(spark, sf_dir))
    return S.score_sentiment(clean, "tweet_parse", scorer=S.lexicon_scorer()).select("tweetid", "polarity", "subjectivity")


def sentiment_table(spark, sf_dir):
    return sentiments(spark, sf_dir).drop("tweetid")


def sentiment_mix(spark, sf_dir):
    return sentiments(spark, sf_dir).groupBy("sentiment", "context").agg(
        F.count(F.lit(1)).alias("n_tweets"))


def _tokens(spark, sf_dir):
    return P.filtered_tokens(sentiments(spark, sf_dir), "tweet")


def tokenize_stopwords(spark, sf_dir):
    return _tokens(spark, sf_dir).select(
        "tweetid", F.array_join("filtered", " ").alias("filtered_text"),
        F.size("filtered").alias("n_filtered"))


def _texts(spark, sf_dir):
    return sentiments(spark, sf_dir, arrow=True).select("tweetid", "tweet")


def vocabulary(spark, sf_dir):
    return P.vocabulary_of_totals(P.text_totals(_texts(spark, sf_dir)))


def vocabulary_cut(spark, sf_dir):
    """A vocabulary of 5,000 terms, fewer than the corpus has."""
    totals = P.text_totals(_texts(spark, sf_dir))
    return P.ranked_cut(totals, 5000, [F.col("n").desc(), F.col("term").asc()])


def idf_table(spark, sf_dir):
    t = P.idf_of_totals(*P.stored_term_totals(_texts(spark, sf_dir), "tweetid"))
    return t.select("term", "doc_freq", F.round("idf", 9).alias("idf"))


def tfidf(spark, sf_dir):
    counts, totals, n_docs = P.stored_counts_and_totals(_texts(spark, sf_dir), "tweetid")
    return P.tfidf(counts, "tweetid", n_docs, totals=totals, decimals=6)


def label_index(spark, sf_dir):
    return P.label_index(sentiments(spark, sf_dir), "sentiment")


def hash_split(spark, sf_dir):
    b = P.hash_bucket("tweetid")
    return sentiments(spark, sf_dir).select(
        "tweetid", b.alias("bucket"),
        F.when(b < 70, "train").otherwise("test").alias("side"))


def prediction_metrics(spark, sf_dir):
    """Accuracy and weighted F1 of "lexicon polarity < 0" as a predictor
    of the ``toxic`` label, over every labelled document."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    labelled = load(spark, sf_dir, "labels").join(docs, "doc_id")
    parsed = labelled.select("doc_id", "toxic",
                             clean_text_expr(flatten_newlines("text")).alias("tweet_parse"))
    scored = S.score_sentiment(parsed, "tweet_parse")
    pred = scored.select(F.col("toxic").cast("double").alias("label"),
                         F.when(F.col("polarity") < 0, 1.0).otherwise(0.0).alias("prediction"))
    m = P.metrics(pred)
    return m.select(F.round("accuracy", 9).alias("accuracy"), F.round("f1", 9).alias("f1"))


def sentiment_lr(spark, sf_dir):
    """Stage 8: fit the TF-IDF + logistic-regression pipeline on the hash
    train side, return test-side predictions (rows-only check)."""
    _, pred = P.fit_predict(sentiments(spark, sf_dir, arrow=True), how="hash", key="tweetid")
    return pred.select("tweetid", "tweet", "sentiment", "label", "prediction")


def model_metrics(spark, sf_dir):
    """Stage 8's end: the fitted model's test predictions, persisted with
    their vectors as a catalog table, and accuracy and weighted F1 of what
    the table holds."""
    _, pred = P.fit_predict(sentiments(spark, sf_dir, arrow=True), how="hash", key="tweetid")
    # the table is external: its files outlive the database, so they may not
    # lie in its folder, which goes with it
    files = scratch_path(spark, "predictions")
    with T.own_database(spark, scratch_path(spark, "warehouse")) as db:
        P.save_predictions(pred, files, f"{db}.predictions")
        return P.metrics(spark.table(f"{db}.predictions").select("label", "prediction"))


def flatten_tweets(spark, sf_dir):
    ev = tweet_events(spark, sf_dir)
    return J.flatten_tweets(ev.filter(J.has_text(ev)))


def track_filter(spark, sf_dir):
    return J.track(tweet_events(spark, sf_dir), ["climate"], ["en"]).select(
        F.col("id").alias("tweetid"), "lang")


def track_many(spark, sf_dir):
    """A thousand keywords, some with signs: the tags of the tweets, one
    keyword in the texts, and words no tweet has."""
    words = [f"word{i}x" for i in range(990)] + [f"c{i}++" for i in range(7)] + ["Climate", "user5:", "http://t.co/7"]
    return J.track(tweet_events(spark, sf_dir), words).select(F.col("id").alias("tweetid"))


def _tsv_files(spark, sf_dir) -> str:
    path = scratch_path(spark, "tsv")
    V.write_tsv_lines(V.to_tsv_line(flatten_tweets(spark, sf_dir)), path)
    return path


def tsv_positional(spark, sf_dir):
    return V.read_tweets_tsv(spark, _tsv_files(spark, sf_dir))


def tsv_realign(spark, sf_dir):
    return V.read_tweets_tsv(spark, _tsv_files(spark, sf_dir), realign=True)


# Micro-batches of the derived stream, in bytes of its compressed lines: what
# is staged at a time does not grow with the input.
BATCH_BYTES = 2 << 30


def _event_files(spark, sf_dir) -> str:
    """A new folder with the JSON lines in ``in``."""
    root = scratch_path(spark, "stream")
    with shuffles_freed(spark):
        V.write_tsv_lines(tweet_event_lines(spark, sf_dir), f"{root}/in")
    return root


def _ingested(spark, sf_dir, **options) -> str:
    """JSON lines derived from the tables -> availableNow stream; output,
    dead letters and counts lie in the folder that is returned."""
    root = _event_files(spark, sf_dir)
    q = S_in.start_ingest(spark, f"{root}/in", f"{root}/out", f"{root}/dead", f"{root}/checkpoint", available_now=True,
                          counts=f"{root}/counts", max_bytes_per_trigger=BATCH_BYTES, **options)
    q.awaitTermination()
    return root


def stream_ingest(spark, sf_dir):
    return S_in.read_ingested(spark, f"{_ingested(spark, sf_dir)}/out").select(*J.FLAT_COLUMNS)


def stream_tsv(spark, sf_dir):
    """Delivery as text lines in hour folders, scanned by the five-level glob."""
    root = _ingested(spark, sf_dir, form="tsv")
    return V.read_tweets_tsv(spark, f"{root}/out/*/*/*/*/*", realign=True)


def stream_recovery(spark, sf_dir):
    """The stream fails once, after its second batch is written and before
    that batch is committed; restarted, it takes the batch again and goes
    on (three batches or so, by files). The rows are those of an undisturbed run, with the restarts."""
    root = _event_files(spark, sf_dir)
    n_files = spark.read.format("binaryFile").load(f"{root}/in").select("path").count()
    failed = []

    def fail_once(batch_id):
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost between write and commit")

    def start():
        return S_in.start_ingest(spark, f"{root}/in", f"{root}/out", f"{root}/dead", f"{root}/checkpoint", available_now=True,
                                 counts=f"{root}/counts", max_files_per_trigger=-(-n_files // 3), after_batch=fail_once)

    restarts = S_in.run_forever(start, pause_s=0, on_failure=S_in.record_failures(spark, f"{root}/failures"))
    return S_in.read_ingested(spark, f"{root}/out").select(*J.FLAT_COLUMNS, F.lit(restarts).alias("restarts"))


def stream_rejects(spark, sf_dir):
    """The rejected lines themselves, with their number."""
    dead = f"{_ingested(spark, sf_dir)}/dead"
    lines = spark.read.option("basePath", dead).text(f"{dead}/batch=*")
    return lines.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def _report_totals(spark, root, form="parquet"):
    report = S_in.error_report(spark, f"{root}/out", f"{root}/dead", f"{root}/counts", form)
    return report.agg(*[F.sum(k).alias(k) for k in S_in.COUNTS], F.max(F.abs("unaccounted")).alias("unaccounted"))


def stream_accounting(spark, sf_dir):
    """What became of all events, each kind measured for itself."""
    return _report_totals(spark, _ingested(spark, sf_dir)).select(*S_in.COUNTS)


def stream_report(spark, sf_dir):
    """The same for a tracked stream delivered as text, with what the kinds
    leave unaccounted for in any batch."""
    root = _ingested(spark, sf_dir, form="tsv", keywords=["climate"], languages=["en"])
    return _report_totals(spark, root, "tsv")


def csv_sink(spark, sf_dir):
    """The tweet view through the tab-separated copy with a header."""
    path = scratch_path(spark, "csv")
    V.write_tsv_csv(tweet_view(spark, sf_dir), path)
    back = spark.read.option("sep", "\t").option("header", True).schema(RAW_TWEET).csv(path)
    return back.select("tweetid", "user_name", "followers", "tweet", "retweet_count", "created_at")


def parquet_sink(spark, sf_dir):
    """The clean table through partitioned Parquet."""
    path = scratch_path(spark, "parquet")
    T.write_parquet(clean_view(spark, sf_dir), path, partition_by=["day_of_week"])
    return spark.read.parquet(path).select("tweetid", "tweet_parse", "day_of_week", "tweet_date")


def table_profile(spark, sf_dir):
    cols = ["tweetid", "tweet", "created_at", "hashtags_and_media", "place_type", "country"]
    return T.profile(tweet_view(spark, sf_dir).select(*cols))


def sink_roundtrip(spark, sf_dir):
    """Stage 5's table flow on catalog tables: save, CTAS split, explode,
    DELETE, UPDATE and overwrite-while-reading via a staged swap."""
    with T.own_database(spark, scratch_path(spark, "warehouse")) as db:
        spark.catalog.setCurrentDatabase(db)
        T.save_table(tweet_view(spark, sf_dir), "tblclimate")
        arrays = T.create_table_as(
            spark, "tblmedia_arrays",
            "SELECT split(hashtags_and_media, ' ') AS media_url FROM tblclimate "
            "WHERE hashtags_and_media IS NOT NULL AND instr(hashtags_and_media, 'http') > 0")
        T.save_table(arrays.select(F.explode("media_url").alias("media_url")), "tblmedia")
        media = spark.table("tblmedia")
        media = T.delete_where(media, F.col("media_url").isNull() | (F.trim("media_url") == "")
                               | (F.instr("media_url", "http") == 0))
        media = T.update_where(media, "media_url", F.replace("media_url", F.lit(","), F.lit("")))
        # a copy in the scratch folder outlives the database
        return stored(T.replace_table(spark, media, "tblmedia"), "tblmedia")


def scoped_rewrite(spark, sf_dir):
    """DELETE and UPDATE on a table partitioned by country: only the
    partitions that hold a row concerned are written anew, and one that
    loses all its rows is dropped."""
    with T.own_database(spark, scratch_path(spark, "warehouse")) as db:
        name = f"{db}.tblplaces"
        places = tweet_view(spark, sf_dir).select("tweetid", "tweet", "retweet_count", F.nullif("country", F.lit("")).alias("country"))
        T.save_table(places, name, partition_by=["country"])
        T.delete_in_place(spark, name, (F.col("country") == "Germany") & (F.col("retweet_count") < 50))
        T.update_in_place(spark, name, {"tweet": F.concat(F.lit("edited "), "tweet"), "retweet_count": F.lit(0)},
                          (F.col("country") == "France") & (F.col("tweetid") % 2 == 0))
        T.delete_in_place(spark, name, F.col("country") == "Spain")
        return stored(spark.table(name), "tblplaces")


def _live(spark, sf_dir):
    return C.drop_null_tweets(clean_view(spark, sf_dir))


def tweets_by_hour(spark, sf_dir):
    return _live(spark, sf_dir).groupBy("tweet_date_string", "hour").agg(
        F.count(F.lit(1)).alias("n_tweets"))


def tweets_by_country(spark, sf_dir):
    return _live(spark, sf_dir).groupBy("country").agg(F.count(F.lit(1)).alias("n_tweets"))


def tweets_by_dow(spark, sf_dir):
    return _live(spark, sf_dir).groupBy("day_of_week").agg(F.count(F.lit(1)).alias("n_tweets"))


QUERIES: dict[str, Query] = {
    "first_mention": first_mention,
    "clean_text": clean_text,
    "time_parts": time_parts,
    "null_profile": null_profile,
    "drop_null_tweets": drop_null_tweets,
    "top_mentions": top_mentions,
    "top_hashtags": top_hashtags,
    "top_media": top_media,
    "term_weights": term_weights,
    "lexicon_sentiment": lexicon_sentiment,
    "lexicon_sentiment_join": lexicon_sentiment_join,
    "sentiment_scorer": sentiment_scorer,
    "sentiment_table": sentiment_table,
    "sentiment_mix": sentiment_mix,
    "tokenize_stopwords": tokenize_stopwords,
    "vocabulary": vocabulary,
    "vocabulary_cut": vocabulary_cut,
    "idf_table": idf_table,
    "tfidf": tfidf,
    "label_index": label_index,
    "hash_split": hash_split,
    "prediction_metrics": prediction_metrics,
    "sentiment_lr": sentiment_lr,
    "model_metrics": model_metrics,
    "flatten_tweets": flatten_tweets,
    "track_filter": track_filter,
    "track_many": track_many,
    "tsv_positional": tsv_positional,
    "tsv_realign": tsv_realign,
    "stream_ingest": stream_ingest,
    "stream_tsv": stream_tsv,
    "stream_recovery": stream_recovery,
    "stream_rejects": stream_rejects,
    "stream_report": stream_report,
    "stream_accounting": stream_accounting,
    "csv_sink": csv_sink,
    "parquet_sink": parquet_sink,
    "table_profile": table_profile,
    "sink_roundtrip": sink_roundtrip,
    "scoped_rewrite": scoped_rewrite,
    "tweets_by_hour": tweets_by_hour,
    "tweets_by_country": tweets_by_country,
    "tweets_by_dow": tweets_by_dow,
}
