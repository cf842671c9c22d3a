"""Embedding near-dedup by a robust-pruned flat graph.

Vectors are compared only inside one label, by cosine in double precision.
Equal vectors are combined first (a third of all rows may be one vector).

1. Shards: sampled vectors are centres (about one in SHARD_ROWS, at most
   MAX_CENTRES); every vector joins the ``overlap`` nearest centres of its
   label, so shards overlap and stay near ``overlap * SHARD_ROWS`` rows --
   dense regions hold more centres.
2. Build: in each shard every member gets neighbours by robust pruning of
   its nearest members and some random ones, and the reverse edges.
3. Union: a vector's adjacency lists of all its shards are joined.
4. Search: in each shard every member is a query; a greedy beam search from
   the shard's medoid finds the query's region, then the range expands from
   every vector within the threshold to its neighbours until nothing new is
   within it.
   The graph does not end at a shard: where a link leads to a vector that
   also lies in another shard, the query goes on there, from that vector, and
   expands along its lists, in rounds until no query has a shard left to
   visit. So a group of near copies larger than a shard is found whole. A
   query visits a shard once; a shard's visitors are split into blocks.
5. Verify: cosine in double precision of the vectors as given.
6. Audit: recall of the links against brute force, for a bounded hashed set
   of queries against all rows; below TARGET_RECALL the overlap is doubled
   and the search repeated.

A pair found in a shard is counted in the first shard both vectors share; a
vector met on a visit is counted by the visitor in the first of its shards
that the visitor comes to. So no pair leaves a task: a shard returns a link
count per vector and a spanning forest of its links. Components come from the
forests.

Defined cases: a null label, a null, empty or zero vector and one with null
or non-finite components link with nothing: n_links 0, a component of their
own. Vectors of other length than the query's do not link. Rows repeating
an id count as vectors of their own; a null vec_id is a component id only
where no member has an id. An empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirp.llm.common import components, stored

THRESHOLD = 0.93
SHARD_ROWS = 800
MAX_CENTRES = 65_536
OVERLAP = 2
NEAR, RANDOM, DEGREE, ALPHA = 32, 16, 24, 1.2
BEAM = 24
BLOCK = 256
VISITORS = 512
VISIT_BLOCK = 64
FRONTIER = 50_000
AUDIT_QUERIES = 256
TARGET_RECALL = 0.95


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def robust_prune(x: np.ndarray, rows: np.ndarray, cand: np.ndarray) -> np.ndarray:
    """At most DEGREE of each row's candidates, -1 for none. Nearest first;
    a chosen one removes those it is nearer to, by ALPHA, than the row."""
    sim = np.einsum("bd,bcd->bc", x[rows], x[cand])
    sim[cand == rows[:, None]] = -2
    order = np.argsort(-sim, axis=1, kind="stable")
    cand, sim = np.take_along_axis(cand, order, 1), np.take_along_axis(sim, order, 1)
    alive = sim > -2
    alive[:, 1:] &= cand[:, 1:] != cand[:, :-1]
    far = 1 - sim                                     # half the squared distance
    v = x[cand]
    between = 1 - np.matmul(v, v.transpose(0, 2, 1))
    chosen = np.zeros(cand.shape, bool)
    for t in range(cand.shape[1]):
        take = alive[:, t] & (chosen.sum(1) < DEGREE)
        chosen[take, t] = True
        alive &= ~(take[:, None] & (ALPHA * between[:, t] <= far))
    return np.where(chosen, cand, -1)


def build_graph(x: np.ndarray, seed: int = 0) -> list[np.ndarray]:
    """Adjacency lists of unit vectors ``x``."""
    n = len(x)
    if n < 2:
        return [np.empty(0, np.int64)] * n
    rng = np.random.default_rng(seed)
    near = min(NEAR, n - 1)
    src, dst = [], []
    for s in range(0, n, BLOCK):
        rows = np.arange(s, min(n, s + BLOCK))
        sim = x[rows] @ x.T
        sim[np.arange(len(rows)), rows] = -2
        top = np.argpartition(-sim, near - 1, axis=1)[:, :near]
        cand = np.concatenate([top, rng.integers(0, n, (len(rows), RANDOM))], axis=1)
        kept = robust_prune(x, rows, cand)
        at = np.nonzero(kept >= 0)
        src.append(rows[at[0]])
        dst.append(kept[at])
    a, b = np.concatenate(src), np.concatenate(dst)
    pairs = np.unique(np.concatenate([a * n + b, b * n + a]))
    return np.split(pairs % n, np.searchsorted(pairs // n, np.arange(1, n)))


def range_search(x: np.ndarray, adj: np.ndarray, queries: np.ndarray, medoid: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, member) pairs within ``threshold`` that the graph leads to.
    ``adj`` is padded with -1; ``queries`` are members."""
    q, n = len(queries), len(x)
    slack = threshold - 1e-6  # the caller verifies
    every = np.arange(q)
    seen = np.zeros((q, n + 1), bool)
    seen[:, n] = True                                 # the padding
    seen[:, medoid] = True
    pool = np.full((q, BEAM), n)
    sims = np.full((q, BEAM), -3.0)
    done = np.ones((q, BEAM), bool)
    pool[:, 0], sims[:, 0], done[:, 0] = medoid, x[queries] @ x[medoid], False
    hit_q = [every[sims[:, 0] >= slack]]
    hit_v = [np.full(len(hit_q[0]), medoid)]

    def look(qs, vs):
        """Unseen (query, member) pairs, once each, with their cosine."""
        code = np.unique(qs * (n + 1) + vs)
        qs, vs = code // (n + 1), code % (n + 1)
        new = ~seen[qs, vs]
        qs, vs = qs[new], vs[new]
        seen[qs, vs] = True
        s = np.einsum("id,id->i", x[queries[qs]], x[vs])
        ok = s >= slack
        hit_q.append(qs[ok])
        hit_v.append(vs[ok])
        return qs, vs, s

    while True:
        open_sims = np.where(done, -3.0, sims)
        best = open_sims.argmax(1)
        live = every[open_sims[every, best] > -3.0]
        if not len(live):
            break
        done[live, best[live]] = True
        nb = adj[pool[live, best[live]]]
        qs, vs, s = look(np.repeat(live, nb.shape[1]), np.where(nb < 0, n, nb).ravel())
        if not len(qs):
            continue
        first = np.searchsorted(qs, every)
        width = int(np.bincount(qs, minlength=q).max())
        more_v, more_s = np.full((q, width), n), np.full((q, width), -3.0)
        at = np.arange(len(qs)) - first[qs]
        more_v[qs, at], more_s[qs, at] = vs, s
        all_v, all_s = np.concatenate([pool, more_v], 1), np.concatenate([sims, more_s], 1)
        all_d = np.concatenate([done, more_s <= -3.0], 1)
        top = np.argpartition(-all_s, BEAM - 1, axis=1)[:, :BEAM]
        pool, sims, done = (np.take_along_axis(z, top, 1) for z in (all_v, all_s, all_d))
    # range expansion: from what is within the threshold on to its neighbours
    fq, fv = np.concatenate(hit_q), np.concatenate(hit_v)
    own = ~seen[every, queries]                       # the query itself is always a start
    seen[every, queries] = True
    fq, fv = np.r_[fq, every[own]], np.r_[fv, queries[own]]
    while len(fq):
        grown = len(hit_q)
        for s in range(0, len(fq), 20_000):
            nb = adj[fv[s:s + 20_000]]
            look(np.repeat(fq[s:s + 20_000], nb.shape[1]), np.where(nb < 0, n, nb).ravel())
        fq, fv = np.concatenate(hit_q[grown:]), np.concatenate(hit_v[grown:])
    qs, vs = np.concatenate(hit_q), np.concatenate(hit_v)
    apart = queries[qs] != vs
    return qs[apart], vs[apart]


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each linked member with the smallest member of its part."""
    low = np.arange(n)
    while True:
        m = np.minimum(low[a], low[b])
        new = low.copy()
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        np.minimum.at(new, low[a], m)
        np.minimum.at(new, low[b], m)
        new = new[new]
        if (new == low).all():
            break
        low = new
    out = np.flatnonzero(low != np.arange(n))
    return out, low[out]


def _local(nid: np.ndarray, neighbours: list[np.ndarray]) -> np.ndarray:
    """The adjacency lists within a shard, as positions padded with -1."""
    place = {v: i for i, v in enumerate(nid.tolist())}
    lists = [[place[v] for v in nb.tolist() if v in place] for nb in neighbours]
    adj = np.full((len(nid), max(1, max(map(len, lists)))), -1)
    for i, l in enumerate(lists):
        adj[i, :len(l)] = l
    return adj


def _verified(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the pairs (x[a], y[b]) in double precision."""
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    cos = np.empty(len(a))
    for s in range(0, len(a), 100_000):
        i, j = a[s:s + 100_000], b[s:s + 100_000]
        cos[s:s + 100_000] = np.einsum("id,id->i", x[i], y[j]) / (nx[i] * ny[j])
    return cos


def _onward(q: np.ndarray, v: np.ndarray, cos: np.ndarray, shards: np.ndarray, shard: int, known):
    """Where links lead: for each query and each other shard of a vector it
    links to, that is not ``known`` for the query, the nearest such vector."""
    qs, to, at, sim = [], [], [], []
    for c in range(shards.shape[1]):
        target = shards[v, c]
        go = (target != shard) & ~known(q, target)
        for out, part in zip((qs, to, at, sim), (q[go], target[go], v[go], cos[go])):
            out.append(part)
    qs, to, at, sim = map(np.concatenate, (qs, to, at, sim))
    order = np.lexsort((-sim, to, qs))
    qs, to, at, sim = qs[order], to[order], at[order], sim[order]
    first = np.ones(len(qs), bool)
    first[1:] = (qs[1:] != qs[:-1]) | (to[1:] != to[:-1])
    return qs[first], to[first], at[first]


def shard_links(x: np.ndarray, nid: np.ndarray, copies: np.ndarray, shards: np.ndarray, shard: int,
                neighbours: list[np.ndarray], threshold: float):
    """Link counts per member (copies counted, pairs owned by this shard
    only), the forest of all links found, and where they lead."""
    n = len(x)
    u = unit(x)
    adj = _local(nid, neighbours)
    medoid = int((u @ u.mean(0)).argmax())
    found = []
    for s in range(0, n, BLOCK):
        queries = np.arange(s, min(n, s + BLOCK))
        qs, vs = range_search(u, adj, queries, medoid, threshold)
        a, b = np.minimum(queries[qs], vs), np.maximum(queries[qs], vs)
        found.append(np.unique(a * n + b))
    code = np.unique(np.concatenate(found))
    a, b = code // n, code % n
    cos = _verified(x, x, a, b)
    real = cos >= threshold
    a, b, cos = a[real], b[real], cos[real]
    common = np.where((shards[a][:, :, None] == shards[b][:, None, :]).any(2), shards[a], np.iinfo(np.int64).max).min(1)
    mine = common == shard
    counts = np.zeros(n, np.int64)
    np.add.at(counts, a[mine], copies[b[mine]])
    np.add.at(counts, b[mine], copies[a[mine]])
    on = _onward(np.r_[a, b], np.r_[b, a], np.r_[cos, cos], shards, shard,
                 lambda q, target: (shards[q] == target[:, None]).any(1))
    return counts, _forest(n, a, b), on


def expand(x: np.ndarray, adj: np.ndarray, queries: np.ndarray, starts: list[np.ndarray], threshold: float):
    """(query, member) pairs within ``threshold`` that the lists lead to from
    each query's starts; ``queries`` are unit vectors of other shards."""
    n = len(x)
    slack = threshold - 1e-6  # the caller verifies
    seen = np.zeros((len(queries), n + 1), bool)
    seen[:, n] = True
    hit_q, hit_v = [], []
    fq = np.repeat(np.arange(len(starts)), [len(s) for s in starts])
    fv = np.concatenate(starts) if len(starts) else np.empty(0, np.int64)
    while len(fq):
        grown = len(hit_q)
        for s in range(0, len(fq), FRONTIER):
            code = np.unique(fq[s:s + FRONTIER] * (n + 1) + fv[s:s + FRONTIER])
            q, v = code // (n + 1), code % (n + 1)
            new = ~seen[q, v]
            q, v = q[new], v[new]
            seen[q, v] = True
            near = np.einsum("id,id->i", queries[q], x[v]) >= slack
            hit_q.append(q[near])
            hit_v.append(v[near])
        met_q, met_v = np.concatenate(hit_q[grown:]), np.concatenate(hit_v[grown:])
        # on to the neighbours not seen yet, a slice of the frontier at a time
        fq, fv = [], []
        for s in range(0, len(met_q), FRONTIER // adj.shape[1] + 1):
            nb = adj[met_v[s:s + FRONTIER // adj.shape[1] + 1]]
            q = np.repeat(met_q[s:s + FRONTIER // adj.shape[1] + 1], nb.shape[1])
            v = np.where(nb < 0, n, nb).ravel()
            open_ = ~seen[q, v]
            code = np.unique(q[open_] * (n + 1) + v[open_])
            fq.append(code // (n + 1))
            fv.append(code % (n + 1))
        fq, fv = (np.concatenate(z) if z else np.empty(0, np.int64) for z in (fq, fv))
    return np.concatenate(hit_q or [fq]), np.concatenate(hit_v or [fv])


def visit_links(x, nid, copies, shards, shard, neighbours, qx, starts, before, now, threshold):
    """The visitors' link counts, the forest over members and visitors (these
    numbered after the members), and where the links lead. ``before`` and
    ``now``: the shards each visitor has seen in earlier rounds and sees in
    this one; a vector that lies in one of the former has been met there."""
    n, u, uq = len(x), unit(x), unit(qx)
    adj = _local(nid, neighbours)
    found = [expand(u, adj, uq[s:s + VISIT_BLOCK], starts[s:s + VISIT_BLOCK], threshold) for s in range(0, len(qx), VISIT_BLOCK)]
    q = np.concatenate([f[0] + s * VISIT_BLOCK for s, f in enumerate(found)])
    v = np.concatenate([f[1] for f in found])
    cos = _verified(qx, x, q, v)
    real = cos >= threshold
    q, v, cos = q[real], v[real], cos[real]
    span = int(max([shards.max()] + [max(l) for l in before + now if len(l)])) + 1

    def codes(lists):
        return np.unique(np.concatenate([i * span + np.asarray(l, np.int64) for i, l in enumerate(lists)]))

    old, new = codes(before), codes(now)
    of = shards[v]
    met = ((of != shard) & np.isin(q[:, None] * span + of, old)).any(1)
    first = np.where(np.isin(q[:, None] * span + of, new), of, np.iinfo(np.int64).max).min(1)
    mine = ~met & (first == shard)
    counts = np.zeros(len(qx), np.int64)
    np.add.at(counts, q[mine], copies[v[mine]])
    known = np.r_[old, new]
    on = _onward(q, v, cos, shards, shard, lambda a, target: np.isin(a * span + target, known))
    return counts, _forest(n + len(qx), n + q, v), on


def _matrix(column) -> np.ndarray:
    """Vectors of one length as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _shards(column) -> np.ndarray:
    lists = column.to_pylist()
    width = max(map(len, lists))
    return np.array([s + s[-1:] * (width - len(s)) for s in lists])


# counts (nid, n), forest edges (nid, to) and onward visits (nid, shard, start)
FOUND = "nid long, n long, to long, shard long, start long"


def _found(nid: np.ndarray, counts: np.ndarray, edges, on) -> pa.Table:
    (a, b), (q, target, start) = edges, on
    m, none = len(nid), np.zeros(0, np.int64)
    parts = [(nid, counts, nid, none, none), (a, np.zeros(len(a), np.int64), b, none, none),
             (q, np.zeros(len(q), np.int64), q, target, start)]
    columns = []
    for c in range(5):
        columns.append(pa.chunked_array([pa.array(p[c], pa.int64()) if len(p[c]) == len(p[0]) else pa.nulls(len(p[0]), pa.int64())
                                         for p in parts]))
    return pa.Table.from_arrays(columns, ["nid", "n", "to", "shard", "start"])


def _search(reps: DataFrame, centres: dict, overlap: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(nid, n) link counts and (a, b) forest edges of all shards."""
    spark = reps.sparkSession
    shared = spark.sparkContext.broadcast(centres)  # at most MAX_CENTRES vectors
    kind = reps.schema["label"].dataType.simpleString()

    def assign(batches):
        for b in batches:
            groups: dict = {}
            for i, (lab, d) in enumerate(zip(b.column("label").to_pylist(), pc.list_value_length(b.column("v")).to_pylist())):
                groups.setdefault((lab, d), []).append(i)
            take, first, lists = [], [], []
            for key, at in groups.items():
                c, base = shared.value[key]
                k = min(overlap, len(c))
                sim = unit(_matrix(b.column("v").take(pa.array(at)))) @ c.T
                near = np.sort(np.argpartition(-sim, k - 1, axis=1)[:, :k], axis=1) + base
                take += np.repeat(at, k).tolist()
                first += near.ravel().tolist()
                lists += [row for row in near.tolist() for _ in range(k)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(first, pa.int64()), pa.array(lists, pa.list_(pa.int64())),
                 b.column("nid").take(pa.array(take, pa.int64())), b.column("copies").take(pa.array(take, pa.int64())),
                 b.column("v").take(pa.array(take, pa.int64()))], ["shard", "shards", "nid", "copies", "v"])

    members = stored(reps.select("label", "nid", "copies", "v").mapInArrow(
        assign, "shard long, shards array<long>, nid long, copies long, v array<double>"), "graph_members")

    def build(t: pa.Table) -> pa.Table:
        t = t.sort_by("nid")
        nid = t.column("nid").to_numpy()
        lists = build_graph(unit(_matrix(t.column("v"))), seed=int(t.column("shard")[0].as_py()))
        return pa.table({"nid": nid, "nb": pa.array([nid[l] for l in lists], pa.list_(pa.int64()))})

    graph = members.groupBy("shard").applyInArrow(build, "nid long, nb array<long>")
    union = graph.groupBy("nid").agg(F.array_distinct(F.flatten(F.collect_list("nb"))).alias("nb"))
    listed = stored(members.join(stored(union, "graph_lists"), "nid")
                    .select("shard", "shards", "nid", "copies", "v", "nb"), "graph_listed")

    def parts(t: pa.Table):
        t = t.sort_by("nid")
        return (_matrix(t.column("v")), t.column("nid").to_numpy(), t.column("copies").to_numpy(), _shards(t.column("shards")),
                t.column("shard")[0].as_py(), [np.array(l, np.int64) for l in t.column("nb").to_pylist()])

    def search(t: pa.Table) -> pa.Table:
        here = parts(t)
        nid = here[1]
        counts, (a, b), (q, target, start) = shard_links(*here, threshold)
        return _found(nid, counts, (nid[a], nid[b]), (nid[q], target, nid[start]))

    def visit(t: pa.Table, visitors: pa.Table) -> pa.Table:
        if not t.num_rows or not visitors.num_rows:
            none = np.zeros(0, np.int64)
            return _found(none, none, (none, none), (none, none, none))
        here = parts(t)
        nid, who = here[1], visitors.column("q").to_numpy()
        place = {v: i for i, v in enumerate(nid.tolist())}
        starts = [np.array([place[s] for s in l], np.int64) for l in visitors.column("starts").to_pylist()]
        counts, (a, b), (q, target, start) = visit_links(
            *here, _matrix(visitors.column("qv")), starts, visitors.column("before").to_pylist(),
            visitors.column("now").to_pylist(), threshold)
        every = np.r_[nid, who]
        return _found(who, counts, (every[a], every[b]), (who[q], target, nid[start]))

    got = stored(listed.groupBy("shard").applyInArrow(search, FOUND), "graph_links")
    rounds = [got]
    visited = listed.filter(F.col("shard") == F.col("shards")[0]).select(F.col("nid").alias("q"), F.col("shards").alias("before"))
    while True:
        asked = (got.filter("shard IS NOT NULL").groupBy(F.col("nid").alias("q"), F.col("shard").alias("target"))
                 .agg(F.collect_set("start").alias("starts"))
                 .join(visited, "q").filter(~F.array_contains("before", F.col("target"))))
        now = asked.groupBy("q").agg(F.collect_set("target").alias("now"))
        asked = stored(asked.join(now, "q").join(reps.select(F.col("nid").alias("q"), F.col("v").alias("qv")), "q"), "graph_visits")
        if asked.isEmpty():
            break
        size = asked.groupBy("target").agg(F.ceil(F.count(F.lit(1)) / VISITORS).alias("blocks"))
        asked = stored(asked.join(size, "target").withColumn("block", F.pmod(F.xxhash64("q"), "blocks")), "graph_visitors")
        places = asked.select(F.col("target").alias("shard"), F.col("block").alias("at_block")).distinct()
        got = stored(listed.join(places, "shard").groupBy("shard", "at_block")
                     .cogroup(asked.select("target", "block", "q", "qv", "starts", "before", "now").groupBy("target", "block"))
                     .applyInArrow(visit, FOUND), "graph_links")
        rounds.append(got)
        visited = stored(visited.join(asked.select("q", "now").distinct(), "q", "left").select(
            "q", F.array_union("before", F.coalesce("now", F.array().cast("array<long>"))).alias("before")), "graph_visited")
    every = rounds[0]
    for r in rounds[1:]:
        every = every.union(r)
    return (every.groupBy("nid").agg(F.sum("n").alias("n")),
            every.filter("nid <> to").select(F.col("nid").alias("a"), F.col("to").alias("b")))


def exact_links(reps: DataFrame, threshold: float = THRESHOLD, queries: int = AUDIT_QUERIES) -> DataFrame:
    """(nid, exact): brute-force link counts (other vectors of the label, not
    the query's own copies) of the ``queries`` vectors of smallest hash,
    against all rows in blocks."""
    chosen = reps.orderBy(F.xxhash64("v", "label"), "nid").limit(queries).collect()  # bounded
    kind: dict = {}
    for r in chosen:
        kind.setdefault((r["label"], len(r["v"])), []).append((r["nid"], r["v"]))
    kind = {k: (np.array([i for i, _ in v]), np.array([x for _, x in v], dtype=np.float64)) for k, v in kind.items()}
    shared = reps.sparkSession.sparkContext.broadcast(kind)

    def run(batches):
        total: dict[int, int] = {}
        for b in batches:
            groups: dict = {}
            for i, (lab, d) in enumerate(zip(b.column("label").to_pylist(), pc.list_value_length(b.column("v")).to_pylist())):
                groups.setdefault((lab, d), []).append(i)
            for key, at in groups.items():
                if key not in shared.value:
                    continue
                ids, q = shared.value[key]
                x = _matrix(b.column("v").take(pa.array(at)))
                nid, copies = (b.column(c).take(pa.array(at)).to_numpy() for c in ("nid", "copies"))
                near = unit(q) @ unit(x).T >= threshold
                near &= ids[:, None] != nid[None, :]
                for i, n in zip(ids.tolist(), near @ copies):
                    total[i] = total.get(i, 0) + int(n)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["nid", "exact"])

    return (reps.select("label", "nid", "copies", "v").mapInArrow(run, "nid long, exact long")
            .groupBy("nid").agg(F.sum("exact").alias("exact")))


def embedding_dedup(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                    threshold: float = THRESHOLD, overlap: int = OVERLAP) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each vector."""
    e = F.col(f"`{embedding}`")
    fine = (F.col(f"`{label}`").isNotNull() & e.isNotNull() & (F.size(e) > 0)
            & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(e, lambda x: x != 0))
    rows = stored(vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").alias("label"),
                                 F.when(F.coalesce(fine, F.lit(False)), F.transform(e, lambda x: x.cast("double"))).alias("v")),
                  "graph_rows")
    reps = stored(rows.filter("v is not null").groupBy("label", "v")
                  .agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"))
                  .withColumn("nid", F.monotonically_increasing_id()), "graph_reps")
    n = reps.count()
    one_in = max(SHARD_ROWS, -(-n // MAX_CENTRES))
    sample = reps.filter(F.pmod(F.xxhash64("v", F.lit(1)), F.lit(one_in)) == 0).select("label", "v")
    least = reps.groupBy("label", F.size("v").alias("d")).agg(F.min_by("v", F.xxhash64("v")).alias("v")).select("label", "v")
    centres, base = {}, 0
    by_label: dict = {}
    for r in sorted({(r["label"], tuple(r["v"])) for r in sample.union(least).collect()}):  # about MAX_CENTRES at most
        by_label.setdefault((r[0], len(r[1])), []).append(r[1])
    for key, vs in by_label.items():
        centres[key] = (unit(np.array(vs)), base)
        base += len(vs)
    while True:
        counts, edges = _search(reps, centres, overlap, threshold)
        audit = (exact_links(reps, threshold).join(counts, "nid")
                 .agg(F.sum("exact").alias("exact"), F.sum(F.least("n", "exact")).alias("found")).first())
        if not audit["exact"] or audit["found"] >= TARGET_RECALL * audit["exact"] or overlap >= base:
            break
        overlap *= 2
    parts = components(edges)
    placed = (reps.join(counts, "nid").join(parts, F.col("nid") == F.col("node"), "left")
              .select("label", "v", "low", (F.col("n") + F.col("copies") - 1).alias("n_links"),
                      F.coalesce("component", "nid").alias("root")))
    lowest = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    placed = placed.join(lowest, "root").select("label", "v", "n_links", "component_id")
    out = rows.join(placed, ["label", "v"], "left")
    component = F.when(F.col("v").isNotNull(), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
