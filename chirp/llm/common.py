"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chirp.session import stored

# ASCII white space as a Java character class; words are what lies between.
SPACE = "[ \\t-\\r]"
NOT_SPACE = "[^ \\t-\\r]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text (null: none) as an array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def without(df: DataFrame, names) -> DataFrame:
    """``df`` without the columns an operator is about to add (an input
    column of the same name is replaced by the operator's)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def numbered(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with ``pos`` (0, 1, ... in each value of ``group``, null being a
    value, by ``order``, which must be total) and ``n``, the group's rows.

    Rows are range-partitioned by (group, order), so one group may fill many
    partitions, and stored with their place in the partition; only a row
    count per partition and one row per group are joined to them."""
    keys = [F.col(group), *[F.col(c) for c in order]]
    pid = F.spark_partition_id()
    ranged = stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "*", pid.alias("_pid"), (F.monotonically_increasing_id() - pid.cast("long") * F.lit(1 << 33)).alias("_i")), "numbered")
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c")).select(
        "_pid", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off"))
    placed = ranged.join(F.broadcast(offsets), "_pid").withColumn("_g", F.col("_off") + F.col("_i"))
    starts = placed.groupBy(F.col(group).alias("_k")).agg(F.min("_g").alias("_start"), F.count(F.lit(1)).alias("n"))
    return placed.join(starts, F.col(group).eqNullSafe(F.col("_k"))).select(
        *df.columns, (F.col("_g") - F.col("_start")).alias("pos"), "n")


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 40) -> DataFrame:
    """Connected components of an undirected edge list: (node, component),
    component being the smallest node id reachable. Nodes without an edge
    are not listed.

    Alternating large-star / small-star rounds: every round points nodes at
    the smallest neighbour known, the edge count never grows, and the list
    ends as one star per component. Each round is stored in the shared
    scratch folder; only two counters per round reach the driver. A hub node
    is aggregated map-side (min) and joined under AQE's skew split."""
    e = (edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
         .filter("u <> v").distinct())
    e = stored(e, "cc")
    state = None
    for _ in range(max_rounds):
        sym = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (sym.join(low, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("x"), F.col("m").alias("y")),
                                           F.struct(F.col("u").alias("x"), F.col("m").alias("y")))).alias("s"))
                 .select(F.col("s.x").alias("u"), F.col("s.y").alias("v")).filter("u <> v").distinct())
        e = stored(small, "cc")
        row = e.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("decimal(38,0)"))).first()
        if (row[0], row[1]) == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        state = (row[0], row[1])
    raise RuntimeError("components did not settle")
