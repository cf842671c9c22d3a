"""Mentions, hashtags, media, top-k and their plans."""

from pyspark.sql import functions as F

from chirp.operators import entities as E


def test_stopword_filter_keeps_null(spark):
    df = spark.createDataFrame([(x,) for x in [None, "", "the", "bob"]], "retweeted_person string")
    got = sorted([r[0] for r in E.mention_tokens(df).collect()], key=lambda x: (x is not None, x))
    assert got == [None, "bob"]


def test_media_tokens(spark):
    df = spark.createDataFrame([(" http://m/a.jpg, https://t.co/x, photo",), ("#a #b",), (None,)],
                               "hashtags_and_media string")
    assert [r[0] for r in E.media_tokens(df).collect()] == ["http://m/a.jpg", "https://t.co/x"]


def test_hashtag_tokens_case_sensitive(spark):
    df = spark.createDataFrame([("#A #a",), (" http://x",)], "hashtags_and_media string")
    assert sorted(r[0] for r in E.hashtag_tokens(df).collect()) == ["#A", "#a"]
    assert sorted(r[0] for r in E.hashtag_tokens(df, normalize=True).collect()) == ["#a", "#a"]


def test_top_k_tie_break_and_plan(spark):
    df = spark.createDataFrame([(x,) for x in "b a c a b d".split()], "t string")
    top = E.top_k(df, "t", 2, "n")
    assert [tuple(r) for r in top.collect()] == [("a", 2), ("b", 2)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_term_weights(spark):
    df = spark.createDataFrame([("a b",), ("a",), ("",)], "s string")
    got = {r.term: (r.n, r.weight) for r in E.term_weights(df, "s").collect()}
    assert got == {"a": (2, 1.0), "b": (1, 0.5)}


def test_no_python_eval_in_entity_plans(spark):
    from chirp.plans import queries as Q
    for name in ["top_mentions", "top_hashtags", "top_media", "clean_text", "lexicon_sentiment"]:
        plan = Q.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
