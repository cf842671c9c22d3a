"""Parquet and catalog tables (A12-A22, A24).

Parquet files cannot be updated in place, so DELETE / UPDATE and
"read-then-overwrite the same table" are expressed as a new DataFrame
written to a staging table that then replaces the original; on a table with
partitions ``delete_in_place`` / ``update_in_place`` write only the
partitions concerned.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chirp.session import open_writers

OPEN_WRITERS = 16
# The Parquet sinks' files. The reference writes snappy, which takes about
# twice the disk on prose; every reader takes either.
PARQUET_FILES = {"compression": "zstd"}


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, compression: str | None = None) -> None:
    """With partitions, each task keeps a writer open for each of up to
    ``OPEN_WRITERS`` folders instead of sorting (and spilling) its whole rows
    by folder; what goes to further folders is sorted. ``compression="snappy"``
    is the reference's."""
    w = df.write.mode("overwrite").options(**PARQUET_FILES)
    if compression:
        w = w.option("compression", compression)
    if not partition_by:
        w.parquet(path)
        return
    with open_writers(df.sparkSession, OPEN_WRITERS):
        w.partitionBy(*partition_by).parquet(path)


def use_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")
    spark.catalog.setCurrentDatabase(name)


@contextmanager
def own_database(spark: SparkSession, location: str):
    """A new database at ``location`` for the time of the block; afterwards
    it and its managed tables are dropped and the current database is the
    one it was."""
    before, db = spark.catalog.currentDatabase(), f"chirp_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{location}'")
    try:
        yield db
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def save_table(df: DataFrame, name: str, path: str | None = None, partition_by: list[str] | None = None) -> None:
    """Managed (or path-backed) Parquet table, overwrite."""
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def create_table_as(spark: SparkSession, name: str, select_sql: str) -> DataFrame:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet AS {select_sql}")
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows surviving ``DELETE ... WHERE predicate`` (NULL keeps the row)."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def update_where(df: DataFrame, column: str, value: Column,
                 predicate: Column | None = None) -> DataFrame:
    """``UPDATE ... SET column = value [WHERE predicate]``."""
    new = value if predicate is None else F.when(F.coalesce(predicate, F.lit(False)), value).otherwise(F.col(column))
    return df.withColumn(column, new)


def delete_in_place(spark: SparkSession, name: str, predicate: Column) -> list[tuple]:
    """``DELETE FROM name WHERE predicate`` on a partitioned Parquet table:
    copy on write of the partitions that hold such a row, see ``_rewrite``."""
    return _rewrite(spark, name, predicate, lambda df: delete_where(df, predicate), F.lit(False))


def update_in_place(spark: SparkSession, name: str, changes: dict[str, Column], predicate: Column) -> list[tuple]:
    """``UPDATE name SET column = value, ... WHERE predicate`` likewise; every
    value is taken from the row as it was. Partition columns cannot change."""
    wrong = set(changes) & set(partition_columns(spark, name)) or set(changes) - set(spark.table(name).columns)
    if wrong:
        raise ValueError(f"not columns that can be set: {sorted(wrong)}")
    hit = F.coalesce(predicate, F.lit(False))
    types = dict(spark.table(name).dtypes)
    return _rewrite(spark, name, predicate, lambda df: df.select(*[
        F.when(hit, changes[c].cast(types[c])).otherwise(F.col(c)).alias(c) if c in changes else F.col(c)
        for c in df.columns]), F.lit(True))


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _rewrite(spark: SparkSession, name: str, predicate: Column, change, stays: Column) -> list[tuple]:
    """Rewrites the partitions of ``name`` that hold a row of ``predicate``
    and returns their values; all other partitions keep their files. The new
    files replace the old ones when the write commits (dynamic partition
    overwrite), so a failure before leaves the table as it was. Partitions
    left without a row (no row outside ``predicate``, and those inside do not
    ``stay``) are dropped. Only partition values reach the driver, which
    lists a table's partitions in any case."""
    keys = partition_columns(spark, name)
    if not keys:
        raise ValueError(f"{name} has no partitions; use replace_table")
    table = spark.table(name)
    hit = F.coalesce(predicate, F.lit(False))
    touched = [tuple(r) for r in table.filter(predicate).select(*keys).distinct().collect()]
    if not touched:
        return []

    def within(values):
        any_of = F.lit(False)
        for v in values:
            same = F.lit(True)
            for k, x in zip(keys, v):
                same = same & (F.col(k).isNull() if x is None else F.col(k) == F.lit(x))
            any_of = any_of | same
        return any_of

    part = table.filter(within(touched))
    full = {tuple(r) for r in part.filter(~hit | stays).select(*keys).distinct().collect()}
    if full:
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(mode)
        spark.conf.set(mode, "dynamic")
        try:
            change(part.filter(within(full))).select(*table.columns).write.insertInto(name, overwrite=True)
        finally:
            spark.conf.set(mode, before)
    for values in touched:
        if values not in full:
            text = ", ".join(f"{k} = {_literal(v)}" for k, v in zip(keys, values))
            spark.sql(f"ALTER TABLE {name} DROP PARTITION ({text})")
    spark.catalog.refreshTable(name)
    return touched


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def replace_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Overwrite table ``name`` with ``df`` even when ``df`` reads ``name``:
    write a staging table first (cuts the lineage to the old files), set the
    old table aside, put the new one in its place, then drop the old one. A
    failure leaves either table under the name or the old one set aside.
    Returns the new table."""
    tag = uuid.uuid4().hex[:8]
    stage, old = f"{name}__stage_{tag}", f"{name}__old_{tag}"
    df.write.mode("overwrite").format("parquet").saveAsTable(stage)
    there = spark.catalog.tableExists(name)
    if there:
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {stage} RENAME TO {name}")
    except Exception:
        if there:
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        raise
    if there:
        drop_table(spark, old)
    return spark.table(name)


def profile(df: DataFrame) -> DataFrame:
    """One pass: row count plus NULL and empty-string counts per column."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for f in df.schema.fields:
        aggs.append(F.count_if(F.col(f.name).isNull()).alias(f"{f.name}__nulls"))
        if f.dataType.simpleString() == "string":
            aggs.append(F.count_if(F.col(f.name) == "").alias(f"{f.name}__empty"))
    return df.agg(*aggs)
