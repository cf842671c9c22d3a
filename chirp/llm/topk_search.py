"""Exact top-k search by inner product with MaxScore.

A vector's components become whole numbers, floor(scale * x). A query's
terms are its non-zero components; the postings of a term are the rows with
a non-zero value there, in two lists by sign. Only the list of the term's
own sign can raise a score, and its largest value bounds by how much.

1. Shards: rows are dealt to shards of about SHARD_ROWS by a stored row
   number; a shard is indexed by the task that searches it.
2. MaxScore in a shard: with terms by rising bound, those whose bounds
   together stay below the threshold (the k-th best score known) are
   non-essential: a row in none of the essential lists cannot enter the
   result. Essential postings are traversed; then the non-essential terms
   are probed, largest bound first, for the rows whose score so far and
   remaining bounds still reach the threshold, which rises as soon as k
   rows are certain to score more.
3. Thresholds: every query first searches the shard it lies in; its k-th
   score there is the threshold it starts with in all others, which answer
   only with rows that reach it.
4. Merge: the shards' results, at most k each, are cut to the k best.

A shard meets the queries in blocks of about BLOCK_QUERIES, one task a pair
of shard and block, so neither a shard nor a block grows with the table.

Defined cases: vectors that are null or hold null or non-finite components,
or one whose whole number has over 53 bits, take no part; an empty vector
scores 0; where lengths differ, missing components count as 0. Every row but
the query's own is a candidate, so repeated rows find each other and a
repeated query answers once for each of its rows; a null id is no query and
comes last among ties; rows of equal id and score tie as stored. A score
beyond a long is null (its rank stands). An empty table, or one without
queries, gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chirp.llm.common import stored

TOP_K = 20
SCALE = 64
SHARD_ROWS = 16_384
BLOCK_QUERIES = 4_096
LONG = 2 ** 63
SCORED_BITS = 53           # of a component; scores then fit a decimal of 38 digits


def whole(vector: Column, scale: int = SCALE, offset: int = 0, bits: int = 62) -> Column:
    """floor(scale * x) + offset of each component, x taken as double; null
    for vectors that are null, or hold a component that is null, not finite
    or, scaled, of more than ``bits`` bits."""
    x = F.transform(vector, lambda v: v.cast("double") * F.lit(float(scale)))
    limit = F.lit(2.0 ** bits)
    fits = F.forall(x, lambda v: F.coalesce((v > -limit) & (v < limit), F.lit(False)))
    return F.when(fits, F.transform(x, lambda v: F.floor(v) + F.lit(offset)))


def matrix(vectors) -> np.ndarray:
    """Vectors as rows, padded with zeros; in numbers wide enough for exact
    inner products (float64 or int64, else Python's)."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return out


def exact_types(rows: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides in a type in which every partial score is exact."""
    width = min(rows.shape[1], queries.shape[1])
    rows, queries = rows[:, :width], queries[:, :width]
    most = [max((abs(int(a.max())), abs(int(a.min())))) if a.size else 0 for a in (rows, queries)]
    bound = most[0] * most[1] * max(width, 1)
    kind = np.float64 if bound < 2 ** 52 else np.int64 if bound < LONG else object
    return rows.astype(kind), queries.astype(kind)


class Shard:
    """Postings by component and sign, and the rows themselves."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.columns = np.ascontiguousarray(rows.T)
        self.lists = []
        for col in self.columns:
            up, down = np.flatnonzero(col > 0), np.flatnonzero(col < 0)
            self.lists.append(((up, col[up]), (down, col[down])))
        self.most = [col.max(initial=0) for col in self.columns]
        self.least = [col.min(initial=0) for col in self.columns]

    def bounds(self, query: np.ndarray) -> list:
        """By how much each term can raise a score here."""
        return [q * self.most[i] if q > 0 else q * self.least[i] for i, q in enumerate(query)]

    def search(self, query: np.ndarray, k: int, threshold, skip: int = -1):
        """(rows, scores) of every row whose score reaches the shard's k-th
        best and ``threshold`` (None: no threshold), ties with the k-th
        included; row ``skip`` is no candidate."""
        bound = self.bounds(query)
        terms = sorted((i for i in range(len(query)) if query[i]), key=lambda i: bound[i])
        split, room = 0, 0
        while threshold is not None and split < len(terms) and room + bound[terms[split]] < threshold:
            room += bound[terms[split]]
            split += 1
        score = np.zeros(len(self.rows), self.rows.dtype)
        if split == 0:  # no threshold that excludes anything: every row is a candidate
            met = np.ones(len(self.rows), bool)
        else:
            met = np.zeros(len(self.rows), bool)
        for i in terms[split:]:  # essential
            for own, (ids, values) in zip((query[i] > 0, query[i] < 0), self.lists[i]):
                score[ids] += values * query[i]
                if own:
                    met[ids] = True
        if 0 <= skip < len(met):
            met[skip] = False
        alive = np.flatnonzero(met)
        score = score[alive]
        loss = [-(query[i] * (self.least[i] if query[i] > 0 else self.most[i])) for i in terms[:split]]
        fall = sum(loss)
        for n in range(split - 1, -1, -1):  # non-essential, largest bound first
            threshold = self._raised(score, k, fall, threshold)
            if threshold is not None:
                still = score + room >= threshold
                if not still.all():
                    alive, score = alive[still], score[still]
            i = terms[n]
            score = score + self.columns[i][alive] * query[i]
            room -= bound[i]
            fall -= loss[n]
        threshold = self._raised(score, k, 0, threshold)
        if threshold is not None:
            good = score >= threshold
            alive, score = alive[good], score[good]
        return alive, score

    @staticmethod
    def _raised(score, k: int, fall, threshold):
        """The threshold after k rows are known to end no lower than their
        score less ``fall``."""
        if len(score) < k:
            return threshold
        if score.dtype == object:
            certain = sorted(score, reverse=True)[k - 1] - fall
        else:
            certain = np.partition(score, len(score) - k)[len(score) - k] - fall
        return certain if threshold is None or certain > threshold else threshold


HITS = "query_row long, query_id long, vec_id long, row long, score "


def _hits(shard: Shard, own: pd.DataFrame, queries: pd.DataFrame, vectors: np.ndarray, k: int, wide: bool) -> pd.DataFrame:
    """The shard's best k rows for each query."""
    place = {r: i for i, r in enumerate(own["row"].tolist())}
    ids = own["vec_id"].to_numpy(dtype=object)
    last = np.array([float("inf") if i is None or i != i else i for i in ids], dtype=object)
    numbers = own["row"].to_numpy()
    out = [[] for _ in range(5)]
    starts = queries["threshold"].tolist() if "threshold" in queries else [None] * len(queries)
    for n, (row, qid, start) in enumerate(zip(queries["row"].tolist(), queries["vec_id"].tolist(), starts)):
        start = None if start is None or start != start else int(start)
        found, scores = shard.search(vectors[n], k, start, place.get(row, -1))
        best = sorted(zip([-int(s) for s in scores], last[found], numbers[found], found))[:k]
        out[0] += [row] * len(best)
        out[1] += [qid] * len(best)
        out[2] += [ids[b[3]] for b in best]
        out[3] += [int(b[2]) for b in best]
        out[4] += [-b[0] for b in best]
    return pd.DataFrame({"query_row": out[0], "query_id": out[1], "vec_id": pd.array(out[2], "Int64"), "row": out[3],
                         "score": [Decimal(s) for s in out[4]] if wide else out[4]})


def search_cell(rows: pd.DataFrame, queries: pd.DataFrame, k: int, wide: bool = False) -> pd.DataFrame:
    """Queries (row, vec_id, q[, threshold]) against one shard's rows (row, vec_id, q)."""
    if not len(rows) or not len(queries):
        return _hits(Shard(np.zeros((0, 0))), rows.iloc[:0], queries.iloc[:0], np.zeros((0, 0)), k, wide)
    rows = rows.sort_values("row")
    index, vectors = exact_types(matrix(rows["q"].tolist()), matrix(queries["q"].tolist()))
    return _hits(Shard(index), rows, queries, vectors, k, wide)


def best_rows(hits: DataFrame, k: int) -> DataFrame:
    """The k best of each query's hits, ranked."""
    w = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _all(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def topk_search(vectors: DataFrame, is_query: str, vec_id: str = "vec_id", vector: str = "embedding", k: int = TOP_K,
                scale: int = SCALE, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): of every row of ``is_query`` (an SQL
    condition on vec_id) its ``k`` best among all other rows."""
    asked_for = F.coalesce(F.expr(is_query), F.lit(False))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
                          whole(F.col(f"`{vector}`"), scale, bits=SCORED_BITS).alias("q"))
    rows = stored(rows.filter("q is not null").withColumn("row", F.monotonically_increasing_id()), "search_rows")
    n, most, width = rows.agg(F.count(F.lit(1)), F.max(F.array_max(F.transform("q", F.abs))), F.max(F.size("q"))).first()
    wide = (most or 0) ** 2 * (width or 0) >= LONG  # a score may need more than a long
    schema = HITS + ("decimal(38,0)" if wide else "long")
    shards = max(1, -(-n // shard_rows))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    queries = rows.filter(asked_for)
    blocks = max(1, -(-queries.count() // block_queries))

    def home(pdf):
        return search_cell(pdf, pdf[pdf["is_query"]], k, wide)

    first = stored(rows.withColumn("is_query", asked_for)
                   .groupBy("shard").applyInPandas(home, schema), "search_home")
    # the k-th score at home, where there are k
    start = first.groupBy("query_row").agg(F.when(F.count("score") >= k, F.min("score")).alias("threshold"))
    asked = queries.join(start, F.col("row") == F.col("query_row"), "left").select(
        F.col("row").alias("at"), F.col("vec_id").alias("id"), F.col("q").alias("terms"), "threshold",
        F.col("shard").alias("home"), F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"),
        _all(shards).alias("shard")).filter("shard <> home")
    met = rows.select("row", "vec_id", "q", "shard", _all(blocks).alias("block"))

    def cell(key, left, right):
        return search_cell(left, right.rename(columns={"at": "row", "id": "vec_id", "terms": "q"}), k, wide)

    others = met.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(cell, schema)
    best = best_rows(first.unionByName(others), k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id",
                       F.col("score").try_cast("long").alias("score"))
