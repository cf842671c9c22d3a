"""What must not grow faster than the input, or go with what it came from."""

import os

import pytest
from pyspark.sql import functions as F

from chirp.operators import prediction as P
from chirp.plans import queries as Q
from chirp.plans import tweet_view as TV
from chirp.session import scratch_path, scratch_root
from chirp.sources import json_tweets as J
from chirp.sources import tables as T
from chirp.sources import tsv as V
from chirp.streaming import ingest as S_in

SMALL = "/root/testdata/sf0.001"


def files(root, end=""):
    root = root.replace("file:", "")
    return [f"{d}/{f}" for d, _, fs in os.walk(root) for f in fs if f.startswith("part-") and f.endswith(end)]


def test_predictions_outlive_their_database(spark, monkeypatch):
    pred = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (1.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    monkeypatch.setattr(P, "fit_predict", lambda *a, **k: (None, pred))
    assert Q.model_metrics(spark, SMALL).first().accuracy == 0.75


def test_filtered_events_stay_in_many_tasks(spark):
    ev = TV.tweet_events(spark, SMALL)
    rows = ev.filter(J.has_text(ev) & (F.col("lang") == "en")).select(F.spark_partition_id().alias("p"), "id", "text")
    assert len({r.p for r in rows.collect()}) > 4


@pytest.mark.parametrize("event_ids", [list(range(40)), [3] * 30 + [None] * 5 + [7, 8], [2 * i for i in range(40)]])
def test_hot_and_missing_documents(spark, tmp_path, event_ids):
    """Every event once for each row of its document, wherever it is dealt."""
    spark.createDataFrame([(e, None, i, "a", 1.0, "{}") for i, e in enumerate(event_ids)],
                          "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                          ).write.parquet(f"{tmp_path}/events.parquet")
    docs = [(0, "zero"), (1, "one"), (3, "three"), (3, "three again"), (None, "none")]
    spark.createDataFrame([(i, t, "en", "s") for i, t in docs], "doc_id long, text string, lang string, source string"
                          ).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(((r.user_id, r.text or "") for r in TV.events_with_text(spark, str(tmp_path)).collect()))
    want = []
    for u, e in enumerate(event_ids):
        texts = [t for i, t in docs if e is not None and i == e % len(docs)] or [""]
        want += [(u, t) for t in texts]
    assert got == sorted(want)


def test_keywords_as_words_signs_and_tags(spark):
    texts = ["Climate!", "climates", "a c1++ b", "c1+++", "xc1++", "straße c1++", None, "x", "_climate"]
    df = spark.createDataFrame([(i, t, ["ABC"] if t == "x" else None) for i, t in enumerate(texts)], "id int, text string, tags array<string>")
    df = df.withColumn("entities", F.struct(F.transform("tags", lambda t: F.struct(t.alias("text"))).alias("hashtags")))
    assert [r.id for r in J.track(df, ["climate", "c1++", "abc"]).orderBy("id").collect()] == [0, 2, 3, 5, 7]
    assert "[^a-z" not in str(J.tracked(["climate", "c1++"]))  # nested unions, evaluated many times slower


def test_totals_are_stored_without_single_texts(spark):
    df = spark.createDataFrame([(1, "b A b "), (2, ""), (3, "the"), (4, None), (5, "b")], "k long, t string")
    totals, n = P.stored_term_totals(df, "k", "t")
    assert n == 4 and sorted(map(tuple, totals.collect())) == [("", 2, 2), ("b", 3, 2)]
    assert sorted(map(tuple, P.term_counts(df, "k", "t").collect())) == [(1, "", 1), (1, "b", 2), (2, "", 1), (5, "b", 1)]
    many = spark.range(3000).select("id", F.concat(F.lit("x x y"), F.col("id")).alias("t")).coalesce(1)
    assert {tuple(r) for r in P.term_counts(many, "id", "t").collect()} == {(i, "x", 2) for i in range(3000)} | {(i, f"y{i}", 1) for i in range(3000)}
    plan = P.tfidf(P.term_counts(df, "k", "t"), "k", 4)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_streams_keep_only_compressed_copies(spark):
    root = scratch_path(spark, "test-stream")
    V.write_tsv_lines(TV.tweet_event_lines(spark, SMALL), f"{root}/in")
    assert files(f"{root}/in") and len(files(f"{root}/in", ".gz")) == len(files(f"{root}/in"))
    S_in.start_ingest(spark, f"{root}/in", f"{root}/out", f"{root}/dead", f"{root}/checkpoint", available_now=True,
                      counts=f"{root}/counts", form="tsv").awaitTermination()
    assert len(files(f"{root}/out", ".gz")) == len(files(f"{root}/out")) > 0
    assert not files(scratch_root(spark) + "/batch") and not [d for d in os.listdir(scratch_root(spark)) if d.startswith("batch-")]
    report = S_in.error_report(spark, f"{root}/out", f"{root}/dead", f"{root}/counts", "tsv").first()
    assert report.lines == 1000 and report.unaccounted == 0


def test_partitioned_write_does_not_sort_whole_rows(spark, monkeypatch):
    seen = []
    original = type(spark.range(1).write).parquet
    monkeypatch.setattr(type(spark.range(1).write), "parquet", lambda w, path, *a, **k: (
        seen.append(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")), original(w, path, *a, **k))[1])
    path = scratch_path(spark, "test-parts")
    T.write_parquet(spark.range(400).withColumn("p", F.col("id") % 40), path, partition_by=["p"])
    assert seen == [str(T.OPEN_WRITERS)] and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    assert sorted((r.id, r.p) for r in spark.read.parquet(path).collect()) == [(i, i % 40) for i in range(400)]


@pytest.mark.parametrize("how", ["hash", "random"])
def test_model_of_stored_vectors_equals_mllib(spark, monkeypatch, how):
    """The stored vectors are those of the pipeline's own stages, and so are the
    predictions; only the test side's text is stored with them."""
    odd = ["", " ", "good  day ", "\tThe GOOD\nday\x0bnow", " bad", None, "bad day the bad", "i am", "straße GOOD\r"]
    rows = [(i, odd[i % len(odd)] if i % 3 == 0 else f"{'good' if i % 2 else 'bad'} day w{i % 7}", "p" if i % 2 else "n") for i in range(300)]
    df = spark.createDataFrame([*rows, (None, "no key", "p")], "tweetid long, tweet string, sentiment string")
    names, kept = [], P.stored
    monkeypatch.setattr(P, "stored", lambda d, name, *a: (names.append((name, kept(d, name, *a))), names[-1][1])[1])
    model, pred = P.fit_predict(df, how=how, max_iter=10, min_doc_freq=2)
    assert dict(names)["model_features"].filter("_train").filter("tweet IS NOT NULL").isEmpty()
    train, test = P.split(P._non_null_text(df, "tweet"), how, "tweetid")
    want_model = P.sentiment_pipeline(max_iter=10, min_doc_freq=2).fit(train)

    def by_term(d, m):
        words = m.stages[2].vocabulary
        return {r.tweetid: (r.tweet, r.label, r.prediction, {words[i]: round(v, 9) for i, v in zip(r.features.indices.tolist(), r.features.values.tolist())}, [round(x, 6) for x in r.probability])
                for r in d.select("tweetid", "tweet", "label", "prediction", "features", "probability").collect()}

    want, got = by_term(want_model.transform(test), want_model), by_term(pred, model)
    assert got == want and len(got) > 50
    assert by_term(model.transform(test), model) == want
    assert {"tweetid", "tweet", "sentiment", "1gram_idf", "features", "label", "rawPrediction", "probability", "prediction"} == set(pred.columns)


def test_filter_of_missing_texts_does_not_make_texts_twice(spark, monkeypatch):
    plans, kept = [], P.stored
    monkeypatch.setattr(P, "stored", lambda d, name, *a: (plans.append((name, d._jdf.queryExecution().optimizedPlan().toString())), kept(d, name, *a))[1])
    df = spark.range(200).select(F.col("id").alias("tweetid"), F.regexp_replace(F.when(F.col("id") % 10 != 9, F.concat(F.lit("a b"), F.col("id"))), "[0-9]{9}", "").alias("tweet"),
                                 F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("sentiment"))
    P.fit_predict(df, max_iter=2)
    assert plans[0][1].count("[0-9]{9}") == 1
