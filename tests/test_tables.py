"""Rewrites limited to the partitions concerned, predictions as a table,
random split, reuse of term counts."""

import os

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from chirp.operators import prediction as P
from chirp.plans import queries as Q
from chirp.session import scratch_path
from chirp.sources import tables as T


def files(spark, name):
    """partition folder -> its data files."""
    root = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first().data_type.replace("file:", "")
    return {os.path.basename(d): sorted(f for f in fs if f.endswith(".parquet")) for d, _, fs in os.walk(root)
            if any(f.endswith(".parquet") for f in fs)}


@pytest.fixture
def db(spark):
    with T.own_database(spark, scratch_path(spark, "test-db")) as name:
        yield name


def test_only_touched_partitions_are_written(spark, db):
    name = f"{db}.t"
    rows = [(i, f"v{i}", p) for i, p in enumerate(["a", "b", "it's", None, "e"] * 4)]
    T.save_table(spark.createDataFrame(rows, "k long, v string, p string"), name, partition_by=["p"])
    before = files(spark, name)
    assert T.delete_in_place(spark, name, (F.col("p") == "a") & (F.col("k") < 10)) == [("a",)]
    after = files(spark, name)
    assert set(after) == set(before) and {d for d in before if before[d] != after[d]} == {"p=a"}
    wrote = T.update_in_place(spark, name, {"v": F.concat("v", F.lit("!"))}, F.col("p").isNull() | (F.col("k") == 1))
    assert set(wrote) == {("b",), (None,)}
    got = {r.k: r.v for r in spark.table(name).collect()}
    assert got[3] == "v3!" and got[8] == "v8!" and got[1] == "v1!" and got[6] == "v6" and 0 not in got and got[10] == "v10"
    now = files(spark, name)
    assert now["p=e"] == before["p=e"]
    # a partition that loses all its rows goes; a predicate that is NULL deletes nothing
    assert T.delete_in_place(spark, name, F.col("p") == "it's") == [("it's",)]
    assert T.delete_in_place(spark, name, F.lit(None).cast("boolean")) == []
    assert T.delete_in_place(spark, name, F.col("p").isNull()) == [(None,)]
    left = {(r.p, r.k) for r in spark.table(name).collect()}
    assert {p for p, _ in left} == {"a", "b", "e"} and len(left) == 10


def test_update_takes_every_value_from_the_row_as_it_was(spark, db):
    name = f"{db}.u"
    T.save_table(spark.createDataFrame([(1, 2, "x"), (3, 4, "y")], "a int, b int, p string"), name, partition_by=["p"])
    T.update_in_place(spark, name, {"a": F.col("b"), "b": F.col("a")}, F.col("a") == 1)
    assert sorted(map(tuple, spark.table(name).collect())) == [(2, 1, "x"), (3, 4, "y")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    for bad in ({"p": F.lit("z")}, {"nothing": F.lit(1)}):
        with pytest.raises(ValueError):
            T.update_in_place(spark, name, bad, F.lit(True))
    T.save_table(spark.range(3), f"{db}.flat")
    with pytest.raises(ValueError):
        T.delete_in_place(spark, f"{db}.flat", F.col("id") == 1)


def test_vectors_come_back_from_a_catalog_table(spark, db):
    rows = [(1, Vectors.sparse(4, [1, 3], [0.5, 2.0]), Vectors.dense([0.25, 0.75]), 1.0), (2, Vectors.sparse(4, [], []), None, 0.0)]
    pred = spark.createDataFrame(rows, ["k", "features", "probability", "label"])
    P.save_predictions(pred, scratch_path(spark, "test-vectors"), f"{db}.predictions")
    back = spark.table(f"{db}.predictions")
    assert [f.dataType for f in back.schema] == [f.dataType for f in pred.schema]
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows))


@pytest.mark.parametrize("key", [None, "id"])
def test_random_split_does_not_depend_on_partitioning(spark, key):
    df = spark.range(3000).select("id", F.concat(F.lit("t"), F.col("id") % 7).alias("tweet"))
    sides = []
    for n in (1, 3, 200):
        train, test = P.split(df.orderBy(F.rand(n)).repartition(n), "random", key)
        sides.append(({r.id for r in train.collect()}, {r.id for r in test.collect()}))
    assert sides[0] == sides[1] == sides[2]
    train, test = sides[0]
    assert not train & test and len(train | test) == 3000 and 0.65 < len(train) / 3000 < 0.75


def test_term_counts_are_computed_once(spark):
    sf = "/root/testdata/sf0.001"
    for query in (Q.tfidf, Q.idf_table):
        plan = query(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert "doc_id" not in plan and "event_id" not in plan  # nothing of the texts' own plan is left
    df = spark.createDataFrame([(1, "b a b"), (2, ""), (3, "the")], "k long, t string")
    counts, n = P.stored_term_counts(df, "k", "t")
    assert n == 3 and sorted(map(tuple, counts.collect())) == [(1, "b", 2), (2, "", 1)]  # a and the are stopwords
