"""SimHash near-dedup by pivot distance tables.

A document's fingerprint has bit i set when over half of its shingles'
XXH64 values (seed 42) have it. Fingerprints at ``max_bits`` or fewer
differing bits are linked; components of links are near-duplicate groups.

Finding the links: a table of Hamming distances to reference fingerprints
(pivots) is computed for every candidate; by the triangle inequality two
fingerprints whose distances to any pivot differ by more than ``max_bits``
cannot be linked and are discarded; survivors are verified on the bits.
Distances to random pivots all lie near 32, so a join key cut from them
would hold most of the corpus. Candidates are therefore met through the
pivots 0 and the 64 one-bit fingerprints, whose distances relative to pivot
0 are the fingerprint's bits: two linked fingerprints agree in these
coordinates outside ``max_bits`` of the BLOCKS bytes, so each fingerprint is
filed under every choice of bytes left out (28 keys for 2 bits). The random
pivots then screen the candidates.

No bucket is unbounded: a key leaves 8 * max_bits bits open, so a bucket
holds at most 65,536 distinct fingerprints (equal ones are combined first).
In buckets over PAIRWISE fingerprints no pairs are formed: fingerprints
equal after masking ``max_bits`` of the open bits are within that distance,
and each such clique is chained to its first member.

Defined cases: a null text is empty; no words: fingerprint zero, linked
like any other; fewer words than ``words``: one shingle of all of them; a
null doc_id is a component id only if its whole group has none; repeated
rows are rows of their own. An empty table gives an empty result. Extra
columns are ignored by ``simhash_dedup`` and carried by ``keep_one``.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirp.llm.common import components, stored

SHINGLE_WORDS = 3
MAX_BITS = 2
BLOCKS = 8
PIVOTS = 32
PAIRWISE = 64
SEED = 42

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)  # byte -> its bits, lowest first


def fingerprint(text: str | None, k: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a whole text."""
    import xxhash
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not w:
        return 0
    grams = map(b" ".join, zip(*(w[i:] for i in range(k)))) if len(w) >= k else [b" ".join(w)]
    h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype="<u8")
    at = h.view(np.uint8).reshape(-1, 8) + np.arange(8, dtype=np.int64) * 256
    ones = np.bincount(at.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    bits = (2 * ones.ravel() > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", k: int = SHINGLE_WORDS) -> DataFrame:
    """``keep`` columns and ``fp``, the fingerprint as a signed integer."""
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_s_text"))

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), k) for t in b.column("_s_text")], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(b.columns[:-1] + [pa.array(fp)], b.schema.names[:-1] + ["fp"])

    schema = T.StructType(rows.schema.fields[:-1] + [T.StructField("fp", T.LongType())])
    return rows.mapInArrow(run, schema)


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Random reference fingerprints, the same in every task."""
    return np.random.default_rng(SEED).integers(0, 2 ** 64, n, dtype=np.uint64)


def _screened_pairs(groups: np.ndarray, max_bits: int, refs: np.ndarray) -> list[np.ndarray]:
    """Links inside each row of ``groups`` (buckets of one size)."""
    n = groups.shape[1]
    i, j = np.triu_indices(n, 1)
    out = []
    step = max(1, 200_000 // len(i))
    for s in range(0, len(groups), step):
        g = groups[s:s + step]
        dist = np.bitwise_count(g[:, :, None] ^ refs).astype(np.int8)  # the pivot distance table
        apart = np.abs(dist[:, i] - dist[:, j]).max(axis=2)
        a, b = g[:, i][apart <= max_bits], g[:, j][apart <= max_bits]
        near = np.bitwise_count(a ^ b) <= max_bits
        out.append(np.stack([a[near], b[near]], axis=1))
    return out


def _clique_links(fp: np.ndarray, open_bits: list[int], max_bits: int) -> list[np.ndarray]:
    """Links chaining a large bucket's near fingerprints together."""
    out = []
    for drop in combinations(open_bits, max_bits):
        mask = ~np.uint64(sum(1 << b for b in drop))
        y = fp & mask
        order = np.argsort(y, kind="stable")
        ys, fs = y[order], fp[order]
        first = np.r_[True, ys[1:] != ys[:-1]]
        head = fs[np.maximum.accumulate(np.where(first, np.arange(len(fs)), 0))]
        out.append(np.stack([head[~first], fs[~first]], axis=1))
    return out


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links that connect every pair of ``distinct.fp`` within
    ``max_bits`` (all pairs of small buckets, chains of large ones)."""
    if max_bits < 1:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    left_out = list(combinations(range(BLOCKS), max_bits))
    width = 64 // BLOCKS

    def signed(m: int) -> int:
        return m - (1 << 64) if m >> 63 else m

    keys = []
    for n, blocks in enumerate(left_out):
        mask = (1 << 64) - 1
        for b in blocks:
            mask &= ~(((1 << width) - 1) << (b * width))
        keys.append(F.struct(F.lit(n).alias("m"), F.col("fp").bitwiseAND(F.lit(signed(mask))).alias("key")))
    filed = (distinct.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.m", "k.key", "fp")
             .repartition("m", "key").sortWithinPartitions("m", "key", "fp"))

    def run(batches):
        refs = pivots()

        def found(m, key, fp):
            new = np.r_[True, (m[1:] != m[:-1]) | (key[1:] != key[:-1])]
            start = np.flatnonzero(new)
            size = np.diff(np.r_[start, len(fp)])
            out = []
            for n in np.unique(size):
                if n < 2:
                    continue
                at = start[size == n]
                if n <= PAIRWISE:
                    out += _screened_pairs(fp[at[:, None] + np.arange(n)], max_bits, refs)
                else:
                    for s in at:
                        open_bits = [b * width + x for b in left_out[m[s]] for x in range(width)]
                        out += _clique_links(fp[s:s + n], open_bits, max_bits)
            e = np.concatenate(out) if out else np.empty((0, 2), np.uint64)
            e = np.unique(np.sort(e, axis=1), axis=0).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], ["a", "b"])

        rest = None  # the last bucket may go on in the next batch
        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)]
            cols[2] = cols[2].view(np.uint64)
            if rest is not None:
                cols = [np.concatenate(p) for p in zip(rest, cols)]
            if not len(cols[0]):
                continue
            same = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            rest = [c[cut:] for c in cols]
            if cut:
                yield found(*[c[:cut] for c in cols])
        if rest is not None:
            yield found(*rest)

    return filed.mapInArrow(run, "a long, b long").distinct()


def grouped(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root): the group of each of the distinct fingerprints."""
    parts = components(links(distinct, max_bits))
    return (distinct.select("fp").join(parts, F.col("fp") == F.col("node"), "left")
            .select("fp", F.coalesce("component", "fp").alias("root")))


def simhash_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
                  max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id), a row for each document."""
    fps = stored(fingerprints(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")),
                              ["doc_id"], "text", words), "simhash_fp")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash_distinct")
    placed = distinct.join(grouped(distinct, max_bits), "fp")
    roots = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = placed.join(roots, "root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
             max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group: the smallest doc_id (nulls last),
    of rows repeating it the first stored."""
    rows = stored(docs.withColumn("_s_row", F.monotonically_increasing_id()), "simhash_rows")
    fps = stored(fingerprints(rows, ["_s_row", doc_id], text, words), "simhash_fp")
    order = F.struct(F.col(f"`{doc_id}`").isNull().alias("none"), F.col(f"`{doc_id}`").alias("id"), F.col("_s_row").alias("row"))
    distinct = stored(fps.groupBy("fp").agg(F.min(order).alias("low")), "simhash_distinct")
    first = (distinct.join(grouped(distinct, max_bits), "fp").groupBy("root").agg(F.min("low").alias("low"))
             .select(F.col("low.row").alias("_s_row")))
    return rows.join(first, "_s_row", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
