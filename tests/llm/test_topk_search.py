"""MaxScore search against brute force."""

import numpy as np
import pytest

from chirp.llm import queries as LQ
from chirp.llm import topk_search as S
from tests.compare import compare, duck
from tests.conftest import SF_ORACLE

EVERY_20 = "vec_id % 20 = 0"


def brute(rows, k=20):
    """Sorted (query_id, rank, vec_id, score) of rows (vec_id, whole numbers)."""
    out = []
    for i, (q, x) in enumerate(rows):
        if q is None or q % 20:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), float("inf") if v is None else v)
                        for j, (v, y) in enumerate(rows) if j != i)
        out += [(q, n + 1, None if v == float("inf") else v, -s) for n, (s, v) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, [v / 64 for v in x], 1, 2) for i, x in rows],
                                 "vec_id long, embedding array<double>, rank int, score int")


def test_query_equals_its_sql(spark):
    ok, msg = compare(LQ.op13_topk(spark, SF_ORACLE), duck(SF_ORACLE), LQ.OP13_SQL)
    assert ok, msg


@pytest.mark.parametrize("shard_rows,block", [(50, 4), (90, 1000), (10_000, 1000)])
def test_shards_and_blocks_change_nothing(spark, shard_rows, block):
    rng = np.random.default_rng(3)
    rows = [(i, [int(v) for v in rng.integers(-5, 6, 6)]) for i in range(400)]
    df = S.topk_search(frame(spark, rows).repartition(5), EVERY_20, shard_rows=shard_rows, block_queries=block)
    assert got(df) == brute(rows)


def test_ties_copies_and_repeated_rows(spark):
    """A third of the rows are one vector; ids repeat; a query's own row is left out, its copies are not."""
    rows = [(i, [3, 1, 0]) for i in range(0, 60, 2)] + [(i, [i % 5, -(i % 3), 1]) for i in range(1, 60, 2)]
    rows += [(20, [3, 1, 0]), (20, [9, 9, 9]), (None, [3, 1, 0])]
    assert got(S.topk_search(frame(spark, rows), EVERY_20, shard_rows=17, block_queries=2)) == brute(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, None), (3, [nan, 1.0]), (4, [1.0, inf]), (5, [None, 1.0]), (6, []), (7, [2.0]),
            (8, [1.0, 1.0, 5.0]), (9, [-0.01, 0.0]), (20, [0.0, 0.0]), (40, None), (10, [1e300, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    left = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if i in (0, 1, 6, 7, 8, 9, 20)]
    assert got(S.topk_search(df, EVERY_20)) == brute(left)
    assert S.topk_search(df.limit(0), EVERY_20).count() == 0
    assert S.topk_search(df.filter("vec_id = 1"), EVERY_20).count() == 0
    assert S.topk_search(df.filter("vec_id = 0"), EVERY_20).count() == 0    # no other row


def test_wide_scores_are_exact_or_null(spark):
    rows = [(0, [2 ** 40, 1]), (1, [2 ** 20 + 1, 3]), (2, [2 ** 20, 3]), (3, [2 ** 40, 0])]
    out = {r["vec_id"]: (r["rank"], r["score"]) for r in S.topk_search(frame(spark, rows), EVERY_20).collect()}
    assert out == {3: (1, None), 1: (2, 2 ** 60 + 2 ** 40 + 3), 2: (3, 2 ** 60 + 3)}


def test_bounds_let_rows_go_unscored():
    """With a threshold, rows in no essential list are never candidates."""
    rows = np.zeros((1000, 3))
    rows[:10, 0] = 50
    rows[:, 1] = 1
    shard, query = S.Shard(rows), np.array([10.0, 1.0, 0.0])
    found, scores = shard.search(query, 5, 400)
    assert found.tolist() == list(range(10)) and set(scores) == {501.0}
