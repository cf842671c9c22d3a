"""A tweet-shaped raw table derived from the shared ``events`` and
``documents`` tables.

Every event is one tweet: id, time and user come from the event, the
text is the whole text of document ``event_id % n`` (n = number of
documents, a scalar subquery Spark evaluates once before the join). The
mention prefix, link suffix, hashtag / media field and place are
decorations derived from the event so that each reference stage has
something to find. Newlines in the text become spaces, as the stream
listener did before landing.

Nothing is filtered or truncated: the view has exactly one row per event.

The join is a left equi-join, so every event stays even where the document
ids have gaps (its text is then NULL). Each output row carries a whole text,
while the events are narrow: sizes that AQE sees before the join say little
about the work behind it, and it would coalesce the join to one task. So
the events are dealt by the join's own key to a fixed number of partitions,
which AQE leaves as it is, and merged there with the documents (broadcasting
the events would leave the work to the documents' few file splits). A
document may back a third of all events: documents of more than one
partition's share of events are cut into slices (``_hot_documents``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chirp.functions.text import flatten_newlines
from chirp.plans.tables import load
from chirp.schemas import RAW_COLUMNS

# Place decorations by user_id % 3 (type, country, code,
# full name, name); documents' language picks the country.
PLACES = {
    "en": ("United Kingdom", "GB", "London, England", "London"),
    "de": ("Germany", "DE", "Berlin, Germany", "Berlin"),
    "fr": ("France", "FR", "Paris, France", "Paris"),
    "es": ("Spain", "ES", "Madrid, Spain", "Madrid"),
}


def _s(c: Column) -> Column:
    return c.cast("string")


def _by_lang(idx: int) -> Column:
    expr = None
    for lang, vals in PLACES.items():
        cond = F.col("lang") == lang
        expr = F.when(cond, vals[idx]) if expr is None else expr.when(cond, vals[idx])
    return expr.otherwise("")


def created_at_text(ts: Column) -> Column:
    """``EEE MMM dd HH:mm:ss +0000 yyyy`` from a timestamp."""
    return F.concat(F.date_format(ts, "EEE MMM dd HH:mm:ss"), F.lit(" +0000 "),
                    F.date_format(ts, "yyyy"))


def tweet_columns() -> dict[str, Column]:
    """The 17 raw columns as expressions over ``events ⋈ documents``."""
    eid, uid = F.col("event_id"), F.col("user_id")
    prefix = (F.when(eid % 3 == 0, F.concat(F.lit("RT @User"), _s(uid), F.lit(": ")))
              .when(eid % 3 == 1, F.concat(F.lit("hey @User"), _s(uid), F.lit(" ")))
              .otherwise(F.lit("")))
    suffix = F.when(eid % 2 == 0, F.concat(F.lit(" http://t.co/"), _s(eid % 97))).otherwise(F.lit(""))
    tweet = F.when(eid % 50 == 49, F.lit(None).cast("string")).otherwise(
        F.concat(prefix, flatten_newlines("text"), suffix))
    created = F.when(eid % 53 == 52, F.lit("garbage")).otherwise(created_at_text(F.col("ts")))
    tags_media = (F.when(eid % 4 == 0, F.concat(F.lit("#"), F.col("event_type"), F.lit(" #climate")))
                  .when(eid % 4 == 1, F.concat(F.lit(" http://pbs/"), _s(eid % 41),
                                               F.lit(".jpg, https://t.co/"), _s(eid % 97),
                                               F.lit(", photo"))))
    has_place = uid % 3 != 0
    place_type = F.when(uid % 3 == 1, "city").when(uid % 3 == 2, "admin").otherwise("")

    def placed(c: Column) -> Column:
        return F.when(has_place, c).otherwise(F.lit(""))

    return {
        "tweetid": eid,
        "user_name": F.concat(F.lit("User"), _s(uid)),
        "screen_name": F.concat(F.lit("user"), _s(uid)),
        "verified": F.when(uid % 10 == 0, "True").otherwise("False"),
        "user_location": F.col("source"),
        "userId": uid,
        "followers": uid * 10,
        "tweet": tweet,
        "favorite_count": F.get_json_object("props", "$.k").cast("int"),
        "retweet_count": F.floor("value").cast("int"),
        "created_at": created,
        "hashtags_and_media": tags_media,
        "place_type": place_type,
        "country": placed(_by_lang(0)),
        "country_code": placed(_by_lang(1)),
        "region": placed(_by_lang(2)),
        "place": placed(_by_lang(3)),
    }


def _hot_documents(keyed: DataFrame, parts: int) -> DataFrame:
    """(hot_key, n_slices) of the documents that more than one part in
    ``parts`` of all events fall on: fewer than ``parts`` rows."""
    n_events = keyed.select(F.count(F.lit(1))).scalar()
    per_doc = keyed.filter(F.col("doc_key").isNotNull()).groupBy(F.col("doc_key").alias("hot_key")).agg(F.count(F.lit(1)).alias("n"))
    return (per_doc.filter(F.col("n") * parts > n_events)
            .select("hot_key", F.ceil(F.col("n") * parts / n_events).cast("int").alias("n_slices")))


def events_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` left join ``documents`` on ``doc_id = event_id % count(documents)``.
    A hot document's events are dealt to slices by a hash, and the document
    is joined to each of them (at most twice the partitions' number of
    copies in all); events without a key are spread likewise."""
    events = load(spark, sf_dir, "events")
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = events.withColumn("doc_key", F.col("event_id") % n_docs)
    hot = F.broadcast(_hot_documents(keyed, parts))
    row_hash = F.xxhash64(*events.columns)
    n_slices = F.when(F.col("doc_key").isNull(), parts).otherwise(F.coalesce("n_slices", F.lit(1)))
    sliced = (keyed.join(hot, F.col("doc_key") == F.col("hot_key"), "left")
              .withColumn("doc_slice", F.pmod(row_hash, n_slices).cast("int"))
              .select(*keyed.columns, "doc_slice").repartition(parts, "doc_key", "doc_slice"))
    copies = (docs.join(hot, F.col("doc_id") == F.col("hot_key"), "left")
              .withColumn("of_slice", F.explode(F.sequence(F.lit(0), F.coalesce("n_slices", F.lit(1)) - 1)))
              .select(*docs.columns, "of_slice"))
    return sliced.join(copies.hint("merge"), (F.col("doc_key") == F.col("doc_id")) & (F.col("doc_slice") == F.col("of_slice")), "left")


def tweet_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = tweet_columns()
    return events_with_text(spark, sf_dir).select(*[cols[c].alias(c) for c in RAW_COLUMNS])


def tweet_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tweets as nested JSON-shaped events, as the provider stream
    would deliver them: text keeps its newlines; hashtags for
    ``event_id % 4`` in (0, 3), one photo for (1, 3), so some tweets carry
    both; a place struct unless ``user_id % 3 == 0``. Events whose tweet
    is NULL in the view come without text (delete notices)."""
    eid, uid = F.col("event_id"), F.col("user_id")
    cols = tweet_columns()
    prefix_text = F.when(eid % 50 == 49, F.lit(None).cast("string")).otherwise(F.concat(
        F.when(eid % 3 == 0, F.concat(F.lit("RT @User"), _s(uid), F.lit(": ")))
        .when(eid % 3 == 1, F.concat(F.lit("hey @User"), _s(uid), F.lit(" ")))
        .otherwise(F.lit("")),
        F.col("text"),
        F.when(eid % 2 == 0, F.concat(F.lit(" http://t.co/"), _s(eid % 97))).otherwise(F.lit(""))))
    tags = F.when((eid % 4 == 0) | (eid % 4 == 3),
                  F.array(F.struct(F.col("event_type").alias("text")),
                          F.struct(F.lit("climate").alias("text"))))
    media = F.when((eid % 4 == 1) | (eid % 4 == 3), F.struct(F.array(F.struct(
        F.concat(F.lit("http://pbs/"), _s(eid % 41), F.lit(".jpg")).alias("media_url"),
        F.concat(F.lit("https://t.co/"), _s(eid % 97)).alias("url"),
        F.lit("photo").alias("type"))).alias("media")))
    place = F.when(uid % 3 != 0, F.struct(
        cols["place_type"].alias("place_type"), cols["country"].alias("country"),
        cols["country_code"].alias("country_code"), cols["region"].alias("full_name"),
        cols["place"].alias("name")))
    return events_with_text(spark, sf_dir).select(
        eid.alias("id"), prefix_text.alias("text"), F.col("lang"),
        cols["favorite_count"].alias("favorite_count"),
        cols["retweet_count"].alias("retweet_count"),
        cols["created_at"].alias("created_at"),
        F.struct(uid.alias("id"), cols["user_name"].alias("name"),
                 cols["screen_name"].alias("screen_name"), (uid % 10 == 0).alias("verified"),
                 F.col("source").alias("location"),
                 (uid * 10).alias("followers_count")).alias("user"),
        F.struct(tags.alias("hashtags")).alias("entities"),
        media.alias("extended_entities"),
        place.alias("place"))


def tweet_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of ``tweet_events``: tweets without text become delete
    notices, and every 89th event is cut short (not JSON) so the
    dead-letter path has work."""
    ev = tweet_events(spark, sf_dir)
    js = F.to_json(F.struct(*[F.col(c) for c in ev.columns]))
    delete = F.concat(F.lit('{"delete":{"status":{"id":'), _s(F.col("id")), F.lit("}}}"))
    line = (F.when(F.col("text").isNull(), delete)
            .when(F.col("id") % 89 == 88, F.substring(js, 1, 25))
            .otherwise(js))
    return ev.select(line.alias("value"))
