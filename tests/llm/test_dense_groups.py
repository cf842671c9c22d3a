"""Groups of distinct near copies that are larger than a shard."""

import numpy as np
import pytest

from chirp.llm import embedding_dedup as G


def planted(size, others, seed=0, dims=32):
    """One group with all pairs at or above 0.93, and vectors apart from it."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=dims)
    base /= np.linalg.norm(base)
    near = base + rng.normal(size=(size, dims)) * 0.1 / np.sqrt(dims)
    return np.concatenate([near, rng.normal(size=(others, dims))])


def exact(x, threshold=0.93):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    return (u @ u.T >= threshold).sum(1) - 1


@pytest.mark.parametrize("size", [2000])
def test_a_group_larger_than_a_shard_is_found_whole(spark, size, monkeypatch):
    monkeypatch.setattr(G, "TARGET_RECALL", 0.0)  # no second pass with more overlap
    x = planted(size, 400)
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int")
    out = {r.vec_id: r for r in G.embedding_dedup(df).collect()}
    want = exact(x)
    got = np.array([out[i].n_links for i in range(len(x))])
    assert (got <= want).all()
    assert got.sum() >= 0.95 * want.sum() and (got[:size] >= 0.95 * want[:size]).all()
    assert {out[i].component_id for i in range(size)} == {0}


def test_visits_count_each_pair_once():
    """Two shards share no member; a visitor counts what it meets, but not
    what lies in a shard it has seen before."""
    x = planted(60, 0)
    nid, copies = np.arange(60), np.ones(60, np.int64)
    lists = [np.setdiff1d(np.arange(60), [i]) for i in range(60)]
    shards = np.array([[5, 9]] * 30 + [[5, 7]] * 30)
    qx = planted(60, 0)[:2] * 1.5
    starts = [np.array([3]), np.array([40])]
    counts, (a, b), (q, to, at) = G.visit_links(x, nid, copies, shards, 5, lists, qx, starts, [[1], [1, 9]], [[5], [5]], 0.93)
    assert counts.tolist() == [60, 30]
    assert set(zip(q.tolist(), to.tolist())) == {(0, 7), (0, 9), (1, 7)}
    counts, _, on = G.visit_links(x, nid, copies, shards, 9, lists, qx, starts, [[1], [1, 5]], [[5, 9], [9]], 0.93)
    assert counts.tolist() == [0, 0]
