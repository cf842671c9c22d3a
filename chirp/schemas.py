"""Declared schemas (A07). All fields nullable, as in the landed data."""

from pyspark.sql.types import (ArrayType, BooleanType, IntegerType,
                               LongType, StringType, StructField, StructType)

# The 17-column flat tweet record landed from the stream.
RAW_TWEET = StructType([
    StructField("tweetid", LongType(), True),
    StructField("user_name", StringType(), True),
    StructField("screen_name", StringType(), True),
    StructField("verified", StringType(), True),
    StructField("user_location", StringType(), True),
    StructField("userId", LongType(), True),
    StructField("followers", LongType(), True),
    StructField("tweet", StringType(), True),
    StructField("favorite_count", IntegerType(), True),
    StructField("retweet_count", IntegerType(), True),
    StructField("created_at", StringType(), True),
    StructField("hashtags_and_media", StringType(), True),
    StructField("place_type", StringType(), True),
    StructField("country", StringType(), True),
    StructField("country_code", StringType(), True),
    StructField("region", StringType(), True),
    StructField("place", StringType(), True),
])

RAW_COLUMNS = [f.name for f in RAW_TWEET.fields]
PLACE_COLUMNS = ["place_type", "country", "country_code", "region", "place"]

# Columns clean_tweets appends, in order.
CLEAN_ADDED = ["retweeted_person", "tweet_parse", "day_of_week", "month_name",
               "month", "day", "hour", "minute", "second", "year",
               "tweet_date_string", "tweet_time_string", "tweet_date"]

# Nested JSON tweet event as delivered by the provider stream.
TWEET_JSON = StructType([
    StructField("id", LongType(), True),
    StructField("text", StringType(), True),
    StructField("lang", StringType(), True),
    StructField("favorite_count", IntegerType(), True),
    StructField("retweet_count", IntegerType(), True),
    StructField("created_at", StringType(), True),
    StructField("user", StructType([
        StructField("id", LongType(), True),
        StructField("name", StringType(), True),
        StructField("screen_name", StringType(), True),
        StructField("verified", BooleanType(), True),
        StructField("location", StringType(), True),
        StructField("followers_count", LongType(), True),
    ]), True),
    StructField("entities", StructType([
        StructField("hashtags", ArrayType(StructType([
            StructField("text", StringType(), True),
        ])), True),
    ]), True),
    StructField("extended_entities", StructType([
        StructField("media", ArrayType(StructType([
            StructField("media_url", StringType(), True),
            StructField("url", StringType(), True),
            StructField("type", StringType(), True),
        ])), True),
    ]), True),
    StructField("place", StructType([
        StructField("place_type", StringType(), True),
        StructField("country", StringType(), True),
        StructField("country_code", StringType(), True),
        StructField("full_name", StringType(), True),
        StructField("name", StringType(), True),
    ]), True),
])
