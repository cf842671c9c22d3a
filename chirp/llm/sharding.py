"""Sharding: longest-processing-time scheduling.

Documents with equal texts form a group that must stay together. Groups,
largest first, go to the least-loaded shard through a heap.

So that the schedule never holds the whole corpus: a group of at least
``1 / HEAVY`` of all bytes is an item of its own (at most HEAVY of them can
exist), every other group joins one of LIGHT hashed items. The heap then
handles at most HEAVY + LIGHT items on the driver, and the shard sizes
differ by less than about one light item (a 1 / LIGHT part of the corpus)
unless one group alone outweighs a fair share.

Slots number the rows of a shard from 0 without gaps: an item's first slot
is known from the schedule; inside an item rows are dealt by id hash to
parts of about PART rows, so a group holding a third of all rows is
numbered by many tasks.

Defined cases: a null text has size 1 and forms one group (a null is not an
empty text); a null doc_id is ordered first; rows repeating id and text get
different slots; ties break on the group's digest. An empty table gives an
empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chirp.llm.common import stored

HEAVY = 4096
LIGHT = 16384
PART = 200_000
PLAN = "kind int, item string, shard int, base long, parts int"


def schedule(items: list[tuple[int, str, int]], shards: int) -> list[int]:
    """Shard of each (size, key, rows) item, by LPT."""
    order = sorted(range(len(items)), key=lambda i: (-items[i][0], items[i][1]))
    heap = [(0, s) for s in range(shards)]
    out = [0] * len(items)
    for i in order:
        load, s = heapq.heappop(heap)
        out[i] = s
        heapq.heappush(heap, (load + items[i][0], s))
    return out


def shard_documents(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, group_id, shard, slot); law ``bytes``."""
    t = F.col(f"`{text}`")
    rows = stored(docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(t, F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        F.coalesce(F.sha2(t, 256), F.lit("null")).alias("group_id")), "shard_rows")
    groups = rows.groupBy("group_id").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    light = F.pmod(F.xxhash64("group_id"), F.lit(LIGHT)).cast("string")
    kind = F.when(F.col("bytes") * HEAVY >= F.lit(total), 1).otherwise(0)
    summed = (groups.withColumn("kind", kind)
              .groupBy("kind", F.when(F.col("kind") == 1, F.col("group_id")).otherwise(light).alias("item"))
              .agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).collect())  # <= HEAVY + LIGHT rows
    plan, used = [], [0] * shards
    order = sorted(summed, key=lambda r: (r["kind"], r["item"]))
    for r, s in zip(order, schedule([(r["bytes"], r["item"], r["rows"]) for r in order], shards)):
        plan.append((r["kind"], r["item"], s, used[s], -(-r["rows"] // PART)))
        used[s] += r["rows"]
    plan = docs.sparkSession.createDataFrame(plan, PLAN)  # same bound
    heavy = plan.filter("kind = 1").select(F.col("item").alias("group_id"), F.lit(True).alias("is_heavy"))
    placed = (rows.join(F.broadcast(heavy), "group_id", "left")
              .withColumn("kind", F.when(F.col("is_heavy"), 1).otherwise(0))
              .withColumn("item", F.when(F.col("is_heavy"), F.col("group_id")).otherwise(light))
              .join(F.broadcast(plan), ["kind", "item"])
              .withColumn("part", F.pmod(F.xxhash64("doc_id", "group_id"), F.col("parts")).cast("int")))
    # rows per part of the items that have several parts; a row per (item, part)
    parts = placed.filter("parts > 1").groupBy("kind", "item", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("kind", "item").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("kind", "item", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    inside = Window.partitionBy("kind", "item", "part").orderBy("doc_id", "group_id")
    numbered = placed.withColumn("rank", F.row_number().over(inside) - 1)
    return (numbered.join(parts, ["kind", "item", "part"], "left")
            .select("doc_id", "size", "text_crc32", "group_id", "shard",
                    (F.col("base") + F.coalesce("skip", F.lit(0)) + F.col("rank")).cast("long").alias("slot")))
