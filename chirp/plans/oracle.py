"""DuckDB SQL equivalents of the registered queries (the correctness
oracle). Written the way the reference states each step (split-based
mention, four separate regex passes), not the way chirp computes it, so
the two forms check each other. Only the shared tables are registered in
DuckDB, so every query inlines the tweet view as CTEs.
"""

from __future__ import annotations

import sys

from chirp.operators.stopwords import HANDLE_STOPWORDS
from chirp.plans.tweet_view import PLACES


def _str(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def _by_lang(idx: int) -> str:
    whens = " ".join(f"WHEN '{lang}' THEN '{vals[idx]}'" for lang, vals in PLACES.items())
    return f"CASE WHEN user_id % 3 <> 0 THEN CASE lang {whens} ELSE '' END ELSE '' END"


TWEET_VIEW = f"""
ek AS (
  SELECT e.*, e.event_id % (SELECT count(*) FROM documents) AS doc_key FROM events e
),
ed AS (
  SELECT ek.*, d.text, d.lang, d.source FROM ek LEFT JOIN documents d ON d.doc_id = ek.doc_key
),
tw AS (
  SELECT
    event_id AS tweetid,
    'User' || {_str('user_id')} AS user_name,
    'user' || {_str('user_id')} AS screen_name,
    CASE WHEN user_id % 10 = 0 THEN 'True' ELSE 'False' END AS verified,
    source AS user_location,
    user_id AS userId,
    user_id * 10 AS followers,
    CASE WHEN event_id % 50 = 49 THEN NULL ELSE
      (CASE event_id % 3 WHEN 0 THEN 'RT @User' || {_str('user_id')} || ': '
                         WHEN 1 THEN 'hey @User' || {_str('user_id')} || ' '
                         ELSE '' END)
      || replace(replace(text, chr(10), ' '), chr(13), ' ')
      || (CASE WHEN event_id % 2 = 0 THEN ' http://t.co/' || {_str('event_id % 97')} ELSE '' END)
    END AS tweet,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS favorite_count,
    CAST(floor(value) AS INTEGER) AS retweet_count,
    CASE WHEN event_id % 53 = 52 THEN 'garbage'
         ELSE strftime(ts, '%a %b %d %H:%M:%S +0000 %Y') END AS created_at,
    CASE event_id % 4
      WHEN 0 THEN '#' || event_type || ' #climate'
      WHEN 1 THEN ' http://pbs/' || {_str('event_id % 41')} || '.jpg, https://t.co/'
                  || {_str('event_id % 97')} || ', photo'
    END AS hashtags_and_media,
    CASE user_id % 3 WHEN 1 THEN 'city' WHEN 2 THEN 'admin' ELSE '' END AS place_type,
    {_by_lang(0)} AS country,
    {_by_lang(1)} AS country_code,
    {_by_lang(2)} AS region,
    {_by_lang(3)} AS place,
    event_type AS _event_type,
    lang AS _lang,
    replace(replace(text, chr(10), ' '), chr(13), ' ') AS _text
  FROM ed
)"""

CLEAN = r"""
cl0 AS (
  SELECT * REPLACE (replace(created_at, '+0000', ' ') AS created_at),
    lower(replace(CASE WHEN instr(tweet, '@') = 0 THEN ''
                       ELSE string_split(string_split(tweet, '@')[2], ' ')[1] END,
                  ':', '')) AS retweeted_person,
    trim(lower(regexp_replace(regexp_replace(regexp_replace(replace(tweet, 'RT @', ''),
         'http\S+', '', 'g'), '[^a-zA-z0-9@]', ' ', 'g'), '\s+', ' ', 'g'))) AS tweet_parse
  FROM tw
),
cl1 AS (
  SELECT *,
    substring(created_at, 1, 3) AS day_of_week,
    substring(created_at, 5, 3) AS month_name,
    strftime(try_strptime(substring(created_at, 5, 3), '%b'), '%m') AS month,
    substring(created_at, 9, 2) AS day,
    substring(created_at, 12, 2) AS hour,
    substring(created_at, 15, 2) AS minute,
    substring(created_at, 18, 2) AS second,
    substring(created_at, 23, 4) AS year
  FROM cl0
),
cl2 AS (
  SELECT *, year || '-' || month || '-' || day AS tweet_date_string,
            hour || ':' || minute || ':' || second AS tweet_time_string
  FROM cl1
),
cl AS (
  SELECT *, try_strptime(tweet_date_string || ' ' || tweet_time_string,
                         '%Y-%m-%d %H:%M:%S') AS tweet_date
  FROM cl2
)"""


def _sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


def q_view(body: str, clean: bool = True, extra: tuple[str, ...] = ()) -> str:
    ctes = (TWEET_VIEW,) + ((CLEAN,) if clean else ()) + extra
    return with_ctes(*ctes, body=body)


HANDLES = f"""
handles AS (
  SELECT retweeted_person FROM cl
  WHERE (retweeted_person IS NULL OR retweeted_person <> '')
    AND (retweeted_person IS NULL OR retweeted_person NOT IN ({_sql_list(HANDLE_STOPWORDS)}))
)"""

HASHTAGS = """
hashtag_tokens AS (
  SELECT unnest(string_split(hashtags_and_media, ' ')) AS hashtags FROM tw
  WHERE hashtags_and_media IS NOT NULL AND instr(hashtags_and_media, '#') > 0
)"""

MEDIA = """
media_split AS (
  SELECT unnest(string_split(hashtags_and_media, ' ')) AS media_url FROM tw
  WHERE hashtags_and_media IS NOT NULL AND instr(hashtags_and_media, 'http') > 0
),
media_tokens AS (
  SELECT replace(media_url, ',', '') AS media_url FROM media_split
  WHERE NOT (media_url IS NULL OR trim(media_url) = '' OR instr(media_url, 'http') = 0)
)"""


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["first_mention"] = q_view("SELECT tweetid, retweeted_person FROM cl")
    q["clean_text"] = q_view("SELECT tweetid, tweet_parse FROM cl")
    q["time_parts"] = q_view(
        "SELECT tweetid, created_at, day_of_week, month_name, month, day, hour, minute, "
        "second, year, tweet_date_string, tweet_time_string, tweet_date FROM cl")
    q["null_profile"] = q_view(
        "SELECT count(*) AS n_rows, count(*) FILTER (WHERE tweet IS NULL) AS null_tweets, "
        "count(*) FILTER (WHERE tweet IS NOT NULL) AS non_null_tweets, "
        "count(*) FILTER (WHERE tweet_parse = '') AS empty_parse FROM cl")
    q["drop_null_tweets"] = q_view(
        "SELECT tweetid, retweeted_person, tweet_parse FROM cl WHERE tweet IS NOT NULL")
    q["top_mentions"] = q_view(
        "SELECT retweeted_person, count(retweeted_person) AS most_retweeted FROM handles "
        "GROUP BY retweeted_person ORDER BY most_retweeted DESC, retweeted_person ASC NULLS LAST "
        "LIMIT 50", extra=(HANDLES,))
    q["top_hashtags"] = q_view(
        "SELECT hashtags, count(hashtags) AS most_hashtags FROM hashtag_tokens "
        "GROUP BY hashtags ORDER BY most_hashtags DESC, hashtags ASC NULLS LAST LIMIT 50",
        clean=False, extra=(HASHTAGS,))
    q["top_media"] = q_view(
        "SELECT count(media_url) AS most_media, media_url FROM media_tokens "
        "GROUP BY media_url ORDER BY most_media DESC, media_url ASC NULLS LAST LIMIT 20",
        clean=False, extra=(MEDIA,))
    q["term_weights"] = q_view(
        "SELECT term, n, n / max(n) OVER () AS weight FROM ("
        " SELECT term, count(*) AS n FROM ("
        "  SELECT unnest(string_split(retweeted_person, ' ')) AS term FROM handles"
        " ) WHERE term IS NOT NULL AND term <> '' GROUP BY term"
        " ORDER BY n DESC, term ASC LIMIT 200)", extra=(HANDLES,))
    for part in (sentiment_oracles, term_oracles, source_oracles):
        try:  # one part that fails leaves the others their SQL
            q.update(part())
        except Exception as e:  # noqa: BLE001
            print(f"no SQL from {part.__name__}: {e!r}", file=sys.stderr)
    return q


# --- sentiment and model stages ---------------------------------------------

def _lexicon_values(rows) -> str:
    vals = ",\n    ".join(
        f"('{t}', CAST({p!r} AS DOUBLE), CAST({s!r} AS DOUBLE), '{k}', CAST({f!r} AS DOUBLE))"
        for t, p, s, k, f in rows)
    return (f"lex_rows(token, p, s, kind, f) AS (VALUES\n    {vals}),\n"
            "lex AS (SELECT token, avg(p) FILTER (WHERE kind = 'word') AS p, avg(s) FILTER (WHERE kind = 'word') AS s,\n"
            "  max(f) FILTER (WHERE kind = 'intensifier') AS f, bool_or(kind = 'negation') AS neg\n"
            "  FROM lex_rows GROUP BY token)")


def _scored(src: str, key: str, text: str) -> str:
    """CTEs scoring ``text`` of ``src`` with the join + lag form."""
    from chirp.operators.sentiment import DEFAULT_LEXICON
    return f"""
{_lexicon_values(DEFAULT_LEXICON)},
toks AS (
  SELECT {key} AS k, unnest(range(len(string_split({text}, ' ')))) AS pos,
         unnest(string_split({text}, ' ')) AS tok
  FROM {src}
),
ctx AS (
  SELECT k, tok, lag(tok, 1) OVER w AS t1, lag(tok, 2) OVER w AS t2
  FROM toks WINDOW w AS (PARTITION BY k ORDER BY pos)
),
hits AS (
  SELECT c.k, wl.p AS wp, wl.s AS ws, i.f AS f1, i.neg AS n1, j.neg AS n2
  FROM ctx c JOIN lex wl ON wl.token = c.tok AND wl.p IS NOT NULL
  LEFT JOIN lex i ON i.token = c.t1
  LEFT JOIN lex j ON j.token = c.t2
),
hit_scores AS (
  SELECT k,
    least(greatest(wp * coalesce(f1, 1.0), -1.0), 1.0)
      * (CASE WHEN (CASE WHEN f1 IS NOT NULL THEN n2 ELSE n1 END) THEN -0.5 ELSE 1.0 END) AS p,
    least(greatest(ws * coalesce(f1, 1.0), 0.0), 1.0) AS s
  FROM hits
),
per_text AS (SELECT k, avg(p) AS polarity, avg(s) AS subjectivity FROM hit_scores GROUP BY k),
scored AS (
  SELECT src.*, coalesce(pt.polarity, 0.0) AS polarity, coalesce(pt.subjectivity, 0.0) AS subjectivity
  FROM {src} src LEFT JOIN per_text pt ON pt.k = src.{key}
)"""


SENT_IN = """
sent_in AS (SELECT * FROM cl WHERE tweet IS NOT NULL)"""

SENTIMENT = """
sentiments AS (
  SELECT tweetid, tweet_parse AS tweet,
    CAST(polarity AS FLOAT) AS polarity, CAST(subjectivity AS FLOAT) AS subjectivity,
    CASE WHEN polarity >= -1 AND polarity < -0.5 THEN 'Very Negative'
         WHEN polarity >= -0.5 AND polarity < 0 THEN 'Negative'
         WHEN polarity = 0 THEN 'Neutral'
         WHEN polarity > 0 AND polarity <= 0.6 THEN 'Positive'
         ELSE 'Very Positive' END AS sentiment,
    CASE WHEN subjectivity >= 0 AND subjectivity < 0.4 THEN 'Objective'
         WHEN subjectivity >= 0.4 AND subjectivity < 0.6 THEN 'Neutral'
         ELSE 'Subjective' END AS context
  FROM scored
)"""


def _filtered_tokens() -> str:
    from chirp.operators.stopwords import spark_english_stopwords
    sw = "[" + _sql_list(spark_english_stopwords()) + "]"
    return f"""
ftok AS (
  SELECT tweetid, list_filter(string_split(tweet, ' '), lambda x: NOT list_contains({sw}, x)) AS filtered
  FROM sentiments
)"""


VOCAB = """
vocab AS (
  SELECT term, count(*) AS n FROM (SELECT unnest(filtered) AS term FROM ftok)
  GROUP BY term ORDER BY n DESC, term ASC LIMIT 65536
),
dfreq AS (
  SELECT term, count(*) AS doc_freq FROM (SELECT tweetid, unnest(list_distinct(filtered)) AS term FROM ftok)
  GROUP BY term
),
idf AS (
  SELECT v.term, d.doc_freq,
    CASE WHEN d.doc_freq >= 5
         THEN ln(((SELECT count(*) FROM ftok) + 1) / (d.doc_freq + 1))
         ELSE 0.0 END AS idf
  FROM vocab v JOIN dfreq d ON d.term = v.term
)"""

DOC_SCORES = """
doc_clean AS (
  SELECT l.doc_id, l.toxic,
    trim(lower(regexp_replace(regexp_replace(regexp_replace(replace(
      replace(replace(d.text, chr(10), ' '), chr(13), ' '), 'RT @', ''),
      'http\\S+', '', 'g'), '[^a-zA-z0-9@]', ' ', 'g'), '\\s+', ' ', 'g'))) AS tweet_parse
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id
)"""


def sentiment_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    scored = _scored("sent_in", "tweetid", "tweet_parse")
    q["lexicon_sentiment"] = q_view(
        "SELECT tweetid, polarity, subjectivity FROM scored", extra=(SENT_IN, scored))
    q["sentiment_table"] = q_view(
        "SELECT tweet, polarity, subjectivity, sentiment, context FROM sentiments",
        extra=(SENT_IN, scored, SENTIMENT))
    q["sentiment_mix"] = q_view(
        "SELECT sentiment, context, count(*) AS n_tweets FROM sentiments GROUP BY sentiment, context",
        extra=(SENT_IN, scored, SENTIMENT))
    q["lexicon_sentiment_join"] = q["lexicon_sentiment"]
    q["sentiment_scorer"] = q["lexicon_sentiment"]
    q["label_index"] = q_view(
        "SELECT sentiment, n, CAST(row_number() OVER (ORDER BY n DESC, sentiment ASC) - 1 AS DOUBLE) "
        "AS label_index FROM (SELECT sentiment, count(*) AS n FROM sentiments GROUP BY sentiment)",
        extra=(SENT_IN, scored, SENTIMENT))
    q["hash_split"] = q_view(
        "SELECT tweetid, bucket, CASE WHEN bucket < 70 THEN 'train' ELSE 'test' END AS side FROM ("
        " SELECT tweetid, CAST(CAST('0x' || substr(md5(CAST(tweetid AS VARCHAR)), 1, 8) AS BIGINT)"
        " % 100 AS INTEGER) AS bucket FROM sentiments)",
        extra=(SENT_IN, scored, SENTIMENT))
    doc_scored = _scored("doc_clean", "doc_id", "tweet_parse")
    q["prediction_metrics"] = with_ctes(DOC_SCORES, doc_scored, """
pred AS (
  SELECT CAST(toxic AS DOUBLE) AS y, CASE WHEN polarity < 0 THEN 1.0 ELSE 0.0 END AS yhat FROM scored
),
pairs AS (SELECT y, yhat, count(*) AS k FROM pred GROUP BY y, yhat),
per AS (
  SELECT y, sum(k) AS n, sum(CASE WHEN y = yhat THEN k ELSE 0 END) AS tp,
    coalesce((SELECT sum(k) FROM pairs p2 WHERE p2.yhat = p1.y), 0) AS m
  FROM pairs p1 GROUP BY y
)""", body="SELECT round(sum(tp) / sum(n), 9) AS accuracy, "
           "round(sum(n * 2 * tp / (n + m)) / sum(n), 9) AS f1 FROM per")
    return q


def term_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    base = (SENT_IN, _scored("sent_in", "tweetid", "tweet_parse"), SENTIMENT, _filtered_tokens())
    q["tokenize_stopwords"] = q_view(
        "SELECT tweetid, array_to_string(filtered, ' ') AS filtered_text, "
        "CAST(len(filtered) AS INTEGER) AS n_filtered FROM ftok", extra=base)
    q["vocabulary"] = q_view("SELECT term, n FROM vocab", extra=base + (VOCAB,))
    q["idf_table"] = q_view("SELECT term, doc_freq, round(idf, 9) AS idf FROM idf", extra=base + (VOCAB,))
    q["tfidf"] = q_view(
        "SELECT t.tweetid, t.term, t.tf, round(t.tf * i.idf, 6) AS tfidf FROM ("
        "  SELECT tweetid, term, count(*) AS tf FROM (SELECT tweetid, unnest(filtered) AS term FROM ftok)"
        "  GROUP BY tweetid, term) t JOIN idf i ON i.term = t.term", extra=base + (VOCAB,))
    q["vocabulary_cut"] = q_view("SELECT term, n, doc_freq FROM vocab JOIN dfreq USING (term)",
                                 extra=base + (VOCAB.replace("LIMIT 65536", "LIMIT 5000"),))
    return q


# --- sources, stream, sinks, feeds ------------------------------------------

FLAT = """
flat AS (
  SELECT tweetid, user_name, screen_name, verified, user_location, userId, followers,
    (CASE tweetid % 3 WHEN 0 THEN 'RT @User' || CAST(userId AS VARCHAR) || ': '
                      WHEN 1 THEN 'hey @User' || CAST(userId AS VARCHAR) || ' ' ELSE '' END)
      || _text
      || (CASE WHEN tweetid % 2 = 0 THEN ' http://t.co/' || CAST(tweetid % 97 AS VARCHAR) ELSE '' END) AS tweet,
    favorite_count, retweet_count, created_at,
    CASE WHEN tweetid % 4 IN (0, 3) THEN '#' || _event_type || ' #climate' END AS hashtags,
    CASE WHEN tweetid % 4 IN (1, 3) THEN ' http://pbs/' || CAST(tweetid % 41 AS VARCHAR)
         || '.jpg, https://t.co/' || CAST(tweetid % 97 AS VARCHAR) || ', photo' END AS media,
    place_type, country, country_code, region, place, _lang
  FROM tw WHERE tweetid % 50 <> 49
)"""

FLAT_COLS = ("tweetid, user_name, screen_name, verified, user_location, userId, followers, "
             "tweet, favorite_count, retweet_count, created_at, hashtags, media, "
             "place_type, country, country_code, region, place")

LINES = """
lines AS (
  SELECT string_split(concat_ws(chr(9),
    CAST(tweetid AS VARCHAR), user_name, screen_name, verified, user_location,
    CAST(userId AS VARCHAR), CAST(followers AS VARCHAR), tweet,
    coalesce(CAST(favorite_count AS VARCHAR), 'None'), coalesce(CAST(retweet_count AS VARCHAR), 'None'),
    created_at, hashtags, media, place_type, country, country_code, region, place), chr(9)) AS a
  FROM flat
)"""


def _nz(x: str) -> str:
    return f"NULLIF({x}, '')"


POSITIONAL = f"""SELECT TRY_CAST({_nz('a[1]')} AS BIGINT) AS tweetid, {_nz('a[2]')} AS user_name,
  {_nz('a[3]')} AS screen_name, {_nz('a[4]')} AS verified, {_nz('a[5]')} AS user_location,
  TRY_CAST({_nz('a[6]')} AS BIGINT) AS userId, TRY_CAST({_nz('a[7]')} AS BIGINT) AS followers,
  {_nz('a[8]')} AS tweet, TRY_CAST({_nz('a[9]')} AS INTEGER) AS favorite_count,
  TRY_CAST({_nz('a[10]')} AS INTEGER) AS retweet_count, {_nz('a[11]')} AS created_at,
  {_nz('a[12]')} AS hashtags_and_media, {_nz('a[13]')} AS place_type, {_nz('a[14]')} AS country,
  {_nz('a[15]')} AS country_code, {_nz('a[16]')} AS region, {_nz('a[17]')} AS place
FROM lines"""

REALIGN = r"""
ra AS (
  SELECT a, len(a) AS n,
    coalesce(list_position(list_transform(a, lambda x: regexp_full_match(x,
      '[A-Z][a-z]{2} [A-Z][a-z]{2} [0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2} [+-][0-9]{4} [0-9]{4}')), true), 0) AS pos
  FROM lines
),
rb AS (SELECT a, n, CASE WHEN pos > 0 THEN pos - 1 ELSE 10 END AS ca FROM ra),
rc AS (SELECT *, a[ca + 2 : n - 5] AS middle FROM rb)"""

REALIGN_SELECT = f"""SELECT TRY_CAST(a[1] AS BIGINT) AS tweetid, {_nz('a[2]')} AS user_name,
  {_nz('a[3]')} AS screen_name, {_nz('a[4]')} AS verified, {_nz('a[5]')} AS user_location,
  TRY_CAST(a[6] AS BIGINT) AS userId, TRY_CAST(a[7] AS BIGINT) AS followers,
  {_nz("array_to_string(a[8 : greatest(ca - 2, 8)], chr(9))")} AS tweet,
  TRY_CAST(a[ca - 1] AS INTEGER) AS favorite_count, TRY_CAST(a[ca] AS INTEGER) AS retweet_count,
  {_nz('a[ca + 1]')} AS created_at,
  coalesce(list_filter(middle, lambda x: starts_with(x, '#'))[1],
           list_filter(middle, lambda x: contains(x, 'http'))[1]) AS hashtags_and_media,
  {_nz('a[n - 4]')} AS place_type, {_nz('a[n - 3]')} AS country, {_nz('a[n - 2]')} AS country_code,
  {_nz('a[n - 1]')} AS region, {_nz('a[n]')} AS place,
  list_filter(middle, lambda x: starts_with(x, '#'))[1] AS hashtags,
  list_filter(middle, lambda x: contains(x, 'http'))[1] AS media
FROM rc"""


def source_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["flatten_tweets"] = q_view(f"SELECT {FLAT_COLS} FROM flat", clean=False, extra=(FLAT,))
    q["stream_ingest"] = q_view(f"SELECT {FLAT_COLS} FROM flat WHERE tweetid % 89 <> 88",
                                clean=False, extra=(FLAT,))
    q["stream_recovery"] = q_view(f"SELECT {FLAT_COLS}, 1 AS restarts FROM flat WHERE tweetid % 89 <> 88",
                                  clean=False, extra=(FLAT,))
    decoded = FLAT.replace("WHERE tweetid % 50 <> 49", "WHERE tweetid % 50 <> 49 AND tweetid % 89 <> 88")
    q["stream_tsv"] = q_view(REALIGN_SELECT, clean=False, extra=(decoded, LINES, REALIGN))
    wanted = ("coalesce(_lang = 'en' AND (tweetid % 4 IN (0, 3) "
              "OR regexp_matches(lower(tweet), '(^|[^a-z0-9_])climate([^a-z0-9_]|$)')), false)")
    q["stream_report"] = q_view(
        "SELECT count(*) AS lines, count(*) FILTER (WHERE tweetid % 89 = 88 AND tweet IS NOT NULL) AS rejected, "
        "count(*) FILTER (WHERE tweet IS NULL) AS without_text, "
        f"count(*) FILTER (WHERE tweetid % 89 <> 88 AND tweet IS NOT NULL AND NOT {wanted}) AS filtered_out, "
        f"count(*) FILTER (WHERE tweetid % 89 <> 88 AND tweet IS NOT NULL AND {wanted}) AS delivered, "
        "CAST(0 AS BIGINT) AS unaccounted FROM tw", clean=False)
    # every 89th line is its JSON cut to 25 characters: {"id":<id>,"text":"...
    q["stream_rejects"] = q_view(
        "SELECT substr('{\"id\":' || CAST(tweetid AS VARCHAR) || ',\"text\":\"' || replace(tweet, '\"', '\\\"'), 1, 25) "
        "AS value, count(*) AS n FROM flat WHERE tweetid % 89 = 88 GROUP BY 1", clean=False, extra=(FLAT,))
    q["stream_accounting"] = q_view(
        "SELECT count(*) AS lines, count(*) FILTER (WHERE tweetid % 89 = 88 AND tweet IS NOT NULL) AS rejected, "
        "count(*) FILTER (WHERE tweet IS NULL) AS without_text, "
        "count(*) FILTER (WHERE tweetid % 89 <> 88 AND tweet IS NOT NULL) AS delivered, "
        "CAST(0 AS BIGINT) AS filtered_out FROM tw", clean=False)
    q["csv_sink"] = q_view(
        "SELECT tweetid, user_name, followers, tweet, retweet_count, created_at FROM tw", clean=False)
    q["parquet_sink"] = q_view("SELECT tweetid, tweet_parse, day_of_week, tweet_date FROM cl")
    prof = []
    for c, text in (("tweetid", False), ("tweet", True), ("created_at", True), ("hashtags_and_media", True),
                    ("place_type", True), ("country", True)):
        prof.append(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}__nulls")
        if text:
            prof.append(f"count(*) FILTER (WHERE {c} = '') AS {c}__empty")
    q["table_profile"] = q_view(f"SELECT count(*) AS n_rows, {', '.join(prof)} FROM tw", clean=False)
    q["track_filter"] = q_view(
        "SELECT tweetid, _lang AS lang FROM flat WHERE _lang = 'en' AND (tweetid % 4 IN (0, 3) "
        "OR regexp_matches(lower(tweet), '(^|[^a-z0-9_])climate([^a-z0-9_]|$)'))",
        clean=False, extra=(FLAT,))
    q["track_many"] = q_view(
        "SELECT tweetid FROM flat WHERE tweetid % 4 IN (0, 3) OR regexp_matches(lower(tweet), "
        r"'(^|[^a-z0-9_])(word([0-9]|[1-9][0-9]|[1-8][0-9]{2}|9[0-8][0-9])x|c[0-6]\+\+|climate|user5:|http://t\.co/7)([^a-z0-9_]|$)')",
        clean=False, extra=(FLAT,))
    q["tsv_positional"] = q_view(POSITIONAL, clean=False, extra=(FLAT, LINES))
    q["tsv_realign"] = q_view(REALIGN_SELECT, clean=False, extra=(FLAT, LINES, REALIGN))
    q["sink_roundtrip"] = q_view("SELECT media_url FROM media_tokens", clean=False, extra=(MEDIA,))
    q["scoped_rewrite"] = q_view(
        "SELECT tweetid, CASE WHEN country = 'France' AND tweetid % 2 = 0 THEN 'edited ' || tweet ELSE tweet END AS tweet, "
        "CASE WHEN country = 'France' AND tweetid % 2 = 0 THEN 0 ELSE retweet_count END AS retweet_count, nullif(country, '') AS country FROM tw "
        "WHERE country IS DISTINCT FROM 'Spain' AND NOT coalesce(country = 'Germany' AND retweet_count < 50, false)", clean=False)
    drop = "FROM cl WHERE tweet IS NOT NULL"
    q["tweets_by_hour"] = q_view(
        f"SELECT tweet_date_string, hour, count(*) AS n_tweets {drop} GROUP BY tweet_date_string, hour")
    q["tweets_by_country"] = q_view(f"SELECT country, count(*) AS n_tweets {drop} GROUP BY country")
    q["tweets_by_dow"] = q_view(f"SELECT day_of_week, count(*) AS n_tweets {drop} GROUP BY day_of_week")
    return q
