"""What a step writes, moves and evaluates must not grow faster than it has to."""

import json

import pytest
from pyspark.sql import functions as F

from chirp.operators import prediction as P
from chirp.plans import queries as Q
from chirp.session import scratch_path, scratch_root
from chirp.sources import json_tweets as J
from chirp.sources import tables as T
from chirp.sources import tsv as V
from chirp.streaming import ingest as S_in
from tests.test_growth import files


def events(spark, n, hot=False):
    """JSON lines: tweets of many hours (or one), some without a date that
    can be parsed, notices and lines that are not JSON."""
    def line(i):
        if i % 29 == 28:
            return '{"text": "cut' if i % 2 else '{"delete":1}'
        day, hour = (7, 12) if hot else (1 + i % 20, i % 24)
        date = "garbage" if i % 31 == 30 else f"Sat May {day:02d} {hour:02d}:34:56 +0000 2022"
        return json.dumps({"id": i, "text": f"tweet {i} " + f"{i * 7919 % 10007} " * 40, "lang": "en", "created_at": date})
    return spark.createDataFrame([(line(i),) for i in range(n)], "value string").repartition(4)


@pytest.mark.parametrize("form", ["parquet", "tsv"])
@pytest.mark.parametrize("hot", [False, True])
def test_a_batch_is_delivered_without_moving_its_rows_again(spark, monkeypatch, form, hot):
    monkeypatch.setattr(S_in, "WRITER_BYTES", 4000)
    seen, kept = [], S_in._deliver
    monkeypatch.setattr(S_in, "_deliver", lambda out, *a: (
        seen.append((out._jdf.queryExecution().executedPlan().toString(), out.select(F.spark_partition_id()).distinct().count())), kept(out, *a)))
    root, lines = scratch_path(spark, "test-deliver"), events(spark, 600, hot)
    S_in.process_batch(lines, 3, f"{root}/out", f"{root}/dead", counts=f"{root}/counts", form=form)
    plan, tasks = seen[0]
    assert "Exchange" not in plan and "Rebalance" not in plan and "Sort" not in plan
    assert tasks > 2  # the hot hour too is written by several tasks
    want = J.decode_json(lines)
    want = J.flatten_tweets(want.filter(F.col(J.CORRUPT).isNull() & J.has_text(want)))
    if form == "tsv":
        got, want = spark.read.text(f"{root}/out", recursiveFileLookup=True), V.to_tsv_line(want)
    else:
        got = S_in.read_ingested(spark, f"{root}/out").select(*want.columns)
    assert got.count() == want.count() > 500
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    report = S_in.error_report(spark, f"{root}/out", f"{root}/dead", f"{root}/counts", form).first()
    assert (report.lines, report.rejected + report.without_text, report.unaccounted) == (600, 20, 0)
    assert not files(scratch_root(spark) + "/batch") and not [c for c in spark.conf.getAll if c == "spark.sql.unionOutputPartitioning"]


def test_a_stream_goes_on_in_batches_of_bytes(spark):
    root = scratch_path(spark, "test-bytes")
    events(spark, 200).write.text(f"{root}/in")
    S_in.start_ingest(spark, f"{root}/in", f"{root}/out", f"{root}/dead", f"{root}/checkpoint", available_now=True,
                      counts=f"{root}/counts", max_bytes_per_trigger=10).awaitTermination()
    report = S_in.error_report(spark, f"{root}/out", f"{root}/dead", f"{root}/counts").collect()
    assert len(report) == 4 and sum(r.lines for r in report) == 200 and all(r.unaccounted == 0 for r in report)


def test_filtered_lines_are_staged_without_their_text(spark, monkeypatch):
    seen, kept = [], S_in._deliver
    monkeypatch.setattr(S_in, "_deliver", lambda *a: (
        seen.append([r.tweet for r in spark.read.parquet(f"{scratch_root(spark)}/batch-*").filter(f"{S_in.KIND} = 'filtered_out'").collect()]), kept(*a)))
    root = scratch_path(spark, "test-filtered")
    S_in.process_batch(events(spark, 50), 0, f"{root}/out", f"{root}/dead", languages=["fr"])
    assert len(seen[0]) > 40 and set(seen[0]) == {None}


def test_parquet_sink_takes_less_than_snappy(spark):
    root = scratch_path(spark, "test-codec")
    words = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(300)), lambda i: F.concat(F.lit("w"), F.pmod(F.xxhash64("id", i), F.lit(5000)))), " ")
    df = spark.range(2000, numPartitions=2).select("id", words.alias("t"), (F.col("id") % 3).alias("p"))
    for name, codec in (("zstd", {}), ("snappy", {"compression": "snappy"})):
        T.write_parquet(df, f"{root}/{name}", partition_by=["p"], **codec)
        assert files(f"{root}/{name}") and all(f".{name}." in f for f in files(f"{root}/{name}"))
    size = {n: sum(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(f"{root}/{n}").agg(F.sum("length")).first())
            for n in ("zstd", "snappy")}
    assert size["zstd"] < 0.75 * size["snappy"]
    a, b = spark.read.parquet(f"{root}/zstd"), spark.read.parquet(f"{root}/snappy")
    assert a.exceptAll(b).isEmpty() and a.count() == 2000


def test_cleaning_in_arrow_batches_equals_the_expressions(spark):
    """Row by row on random strings of everything the steps look at."""
    import random

    from chirp.functions.text import clean_text
    rng = random.Random(5)
    bits = ["RT @", "RT", " @", "http", "https://t.co/a", "HTTP", "h", "ttp", " ", "  ", "\t", "\n", "\x0b", "\f", "\r", "\x1c", " ", " ", "a", "Zb", "9",
            "_", "@", "[", "]", "\\", "^", "`", ".", "'", "é", "İ", "ſ", "K", "ß", "漢", "😀", "\x00", "\x7f", "\u0085"]
    rows = [None, "", " ", "http", "http ", "xhttp://a b", "hRT @ttp x", "RT RT @@"] + ["".join(rng.choices(bits, k=rng.randrange(14))) for _ in range(6000)]
    df = spark.createDataFrame(list(enumerate(rows)), "id long, t string").repartition(3)
    df = df.unionByName(spark.createDataFrame([(-1, bytearray(b"a\xffB\xc3 http\xff\xfe c")), (-2, bytearray(b"\xff"))], "id long, b binary")
                        .select("id", F.expr("cast(b as string)").alias("t")))
    for strict in (False, True):
        both = df.select("id", "t", clean_text("t", strict=strict).alias("want"), clean_text("t", strict=strict, arrow=True).alias("got"))
        assert both.filter(~F.col("want").eqNullSafe(F.col("got"))).collect() == []


def test_vocabulary_makes_each_text_once_and_moves_totals_only(spark):
    """One cleaning and one count a text, wherever missing texts are left out."""
    seen = []
    for query in (Q.vocabulary, Q.idf_table, Q.tfidf):
        kept = P.stored
        try:
            P.stored = lambda d, name, *a: (seen.append(d._jdf.queryExecution().optimizedPlan().toString()), kept(d, name, *a))[1]
            if query is Q.vocabulary:
                seen.append(P.text_totals(Q._texts(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString())
            query(spark, "/root/testdata/sf0.001")
        finally:
            P.stored = kept
    assert all(p.count("ArrowEvalPython") <= 1 and "http" + r"\S+" not in p for p in seen) and sum("ArrowEvalPython" in p for p in seen) == 3
    df = spark.createDataFrame([(1, "b A b "), (2, ""), (3, "the"), (4, None), (5, "b")] * 700, "k long, t string").coalesce(2)
    want = P.term_totals(P.term_counts(df, "k", "t"))
    got = P.text_totals(df, "t")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) == [("", 1400, 1400), ("b", 2100, 1400)]


def test_rounded_weights_and_stored_totals_equal_the_plain_ones(spark, monkeypatch):
    df = spark.createDataFrame([(i, " ".join(["w" + str(i % 7)] * (i % 30 + 1) + ["x", "", "the"])) for i in range(90)] + [(90, None), (91, ""), (None, "x y")],
                               "k long, t string").repartition(3)
    plain = P.term_counts(df, "k", "t")
    counts, totals, n = P.stored_counts_and_totals(df, "k", "t")
    assert n == 92 and sorted(map(str, counts.collect())) == sorted(map(str, plain.collect()))
    assert sorted(map(tuple, totals.collect())) == sorted(map(tuple, P.term_totals(plain).select("term", "n", "doc_freq").collect()))
    want = P.tfidf(plain, "k", n, min_doc_freq=2).withColumn("tfidf", F.round("tfidf", 6))
    got = P.tfidf(counts, "k", n, min_doc_freq=2, totals=totals, decimals=6)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    seen, kept = [], P.ranked_cut  # the vocabulary is cut from the batches' totals, without grouping the counts of single texts
    monkeypatch.setattr(P, "ranked_cut", lambda d, *a: (seen.append(d._jdf.queryExecution().optimizedPlan().toString()), kept(d, *a))[1])
    P.tfidf(counts, "k", n, totals=totals, decimals=6)
    assert "isnotnull(doc_freq" in seen[0]


@pytest.mark.parametrize("query", ["sentiment_lr", "model_metrics"])
def test_model_texts_are_cleaned_in_arrow_batches_once(spark, monkeypatch, query):
    seen = []

    class Seen(Exception):
        pass

    def fit(df, **_):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        raise Seen

    monkeypatch.setattr(P, "fit_predict", fit)
    with pytest.raises(Seen):
        getattr(Q, query)(spark, "/root/testdata/sf0.001")
    assert seen[0].count("ArrowEvalPython") == 1 and r"http\S+" not in seen[0]
