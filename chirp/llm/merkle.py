"""Merkle manifest of a dataset as a persistent tree with path copying.

Every row is a leaf, the SHA-256 (lowercase hex) of its columns; a column is
``-`` if null, else its UTF-8 byte count, ``:`` and its value. In each group
(``lang``) the leaves, by id, are folded by runs of FAN into their hash until
one node is left, the group's subroot; the subroots, by group (null first),
are folded likewise into the root.

The tree is persistent: a changed leaf makes a new version that shares every
untouched node with the original tree and copies only the leaf's ancestors.

1. Blocks: a task holds one aligned block of 512 leaves (a whole subtree of
   HEIGHT levels), builds its base nodes, and copies the ancestors of
   each changed leaf against them.
2. Upper tree: the blocks' roots are the leaves of the next round, again in
   aligned blocks, until one node a group is left; then the subroots. A
   round holds 1 / 512 of the nodes of the round before.
3. Upper versions: a block has one path of siblings from its root to the
   root of all (composed from the rounds, one row a block); the versions of
   its leaves go on along that path where they are, spread over the tasks
   by block.

Texts are hashed where they are read and never shuffled; what moves is a
leaf's position and hashes. Nothing is collected but the largest group's
node count, once a round.

Defined cases: a null group is a group, the first; null ids come first; rows
of equal id are ordered by leaf hash, then as stored; repeated rows are
leaves of their own; a group of one leaf has it as subroot, a single group's
subroot is the root; a leaf without siblings has the hash of the empty text
as proof; null columns hash as ``-``, empty texts as ``0:``; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirp.llm.common import numbered, stored

FAN = 8
HEIGHT = 3  # levels of a block: 512 leaves
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def field(c: Column) -> Column:
    """A column as it enters a leaf."""
    text = c.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def every_third(doc_id: Column) -> Column:
    """Ids whose unsigned CRC-32 (of the decimal id) 3 divides; not null ones."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


# --- inside one block ------------------------------------------------------

def levels_in_block(n: int, height: int) -> int:
    """Levels a block of a group of ``n`` nodes is folded by: ``height``
    while the group has several blocks, else until one node is left."""
    levels = 0
    while levels < height and FAN ** levels < n:
        levels += 1
    return levels


def base_nodes(leaves: list[str], height: int) -> list[list[str]]:
    """The nodes of a block, level by level from its leaves."""
    levels = [leaves]
    for _ in range(height):
        below = levels[-1]
        levels.append([digest("".join(below[i:i + FAN])) for i in range(0, len(below), FAN)])
    return levels


def siblings(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    """Per level, the nodes left and right of leaf ``i``'s ancestor in its run."""
    out = []
    for nodes in levels[:-1]:
        start = i - i % FAN
        out.append(("".join(nodes[start:i]), "".join(nodes[i + 1:start + FAN])))
        i //= FAN
    return out


def copy_path(path: list[tuple[str, str]], leaf: str) -> list[str]:
    """The ancestors a version with ``leaf`` in this place copies, the last
    being its root; every other node is shared with the base tree."""
    copies = []
    for left, right in path:
        leaf = digest(left + leaf + right)
        copies.append(leaf)
    return copies


# --- distributed levels ----------------------------------------------------

def blocks(nodes: DataFrame, carried: list[str], height: int) -> DataFrame:
    """Nodes (k, pos, n, ...) as one row for each aligned block: (k, block,
    n, rows), the rows sorted by position."""
    return nodes.groupBy("k", F.floor(F.col("pos") / FAN ** height).alias("block")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", *carried))).alias("rows"))


def _block_rows(batch: pa.RecordBatch):
    """(k, n, columns of the block's rows) of each block of a batch."""
    rows = batch.column("rows")
    ks, ns = batch.column("k").to_pylist(), batch.column("n").to_pylist()
    for i in range(len(ks)):
        part = rows.slice(i, 1).flatten()
        names = [part.type.field(j).name for j in range(part.type.num_fields)]
        yield ks[i], ns[i], dict(zip(names, [c.to_pylist() for c in part.flatten()]))


def upper_paths(nodes: DataFrame, height: int) -> DataFrame:
    """(k, pos, n, left, right, root): of each node its siblings within its
    block, level by level, and the block's root."""
    def run(batches):
        for b in batches:
            out = {c: [] for c in ("k", "pos", "n", "left", "right", "root")}
            for k, n, rows in _block_rows(b):
                levels = base_nodes(rows["digest"], levels_in_block(n, height))
                for i, pos in enumerate(rows["pos"]):
                    path = siblings(levels, i)
                    for c, v in zip(out, (k, pos, n, [p[0] for p in path], [p[1] for p in path], levels[-1][0])):
                        out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=PATHS)

    return blocks(nodes, ["digest"], height).mapInArrow(
        run, "k string, pos long, n long, left array<string>, right array<string>, root string")


PATHS = pa.schema([("k", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("left", pa.list_(pa.string())),
                   ("right", pa.list_(pa.string())), ("root", pa.string())])


def climb(nodes: DataFrame, height: int = HEIGHT) -> DataFrame:
    """(k, pos, left, right, top) of nodes (k, pos, n, digest): each node's
    siblings on the whole way to its group's top, and that top."""
    block, rounds = FAN ** height, []
    while (nodes.agg(F.max("n")).first()[0] or 0) > 1:
        paths = stored(upper_paths(nodes, height), "merkle_paths")
        rounds.append(paths)
        nodes = paths.filter(F.col("pos") % block == 0).select(
            "k", F.floor(F.col("pos") / block).alias("pos"), F.ceil(F.col("n") / block).alias("n"),
            F.col("root").alias("digest"))
    none = F.array().cast("array<string>")
    done = nodes.select("k", "pos", none.alias("left"), none.alias("right"), F.col("digest").alias("top"))
    for lower in reversed(rounds):
        up = done.select(F.col("k").alias("uk"), F.col("pos").alias("upos"), F.col("left").alias("ul"),
                         F.col("right").alias("ur"), "top")
        done = lower.join(up, F.col("k").eqNullSafe(F.col("uk")) & (F.floor(F.col("pos") / block) == F.col("upos"))).select(
            "k", "pos", F.concat("left", "ul").alias("left"), F.concat("right", "ur").alias("right"), "top")
    return done


# --- the operator ----------------------------------------------------------

def leaves(docs: DataFrame, doc_id: str, group: str, columns: list[str], changed_text: str, changed: Column) -> DataFrame:
    """(k, doc_id, leaf, new): ``new`` is the leaf after tampering, null
    where the row is left alone. Stored, so texts are read once."""
    cols = [F.col(f"`{c}`") for c in columns]
    new = leaf_hash([lower_ascii(c) if name == changed_text else c for name, c in zip(columns, cols)])
    return stored(docs.select(
        F.col(f"`{group}`").cast("string").alias("k"), F.col(f"`{doc_id}`").alias("doc_id"), leaf_hash(cols).alias("leaf"),
        F.when(changed, new).alias("new"), F.monotonically_increasing_id().alias("row")), "merkle_leaves")


VERSIONS = [("lang", "string"), ("leaf", "string"), ("subroot", "string"), ("root", "string"), ("proof_sha256", "string"),
            ("folded_root", "string"), ("verified", "boolean"), ("copied_nodes", "array<string>")]


def merkle_manifest(docs: DataFrame, doc_id: str = "doc_id", group: str = "lang",
                    columns=("doc_id", "source", "lang", "n_chars", "text"), text: str = "text",
                    changed: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """(doc_id, lang, leaf, subroot, root, proof_sha256, folded_root,
    verified, copied_nodes), a row for each leaf. Rows of ``changed`` (a
    condition on the input) have A-Z of ``text`` lower-cased; their version's
    copied ancestors, up to its root, are ``copied_nodes`` (else null)."""
    changed = every_third(F.col(f"`{doc_id}`")) if changed is None else changed
    placed = numbered(leaves(docs, doc_id, group, list(columns), text, changed), "k", ["doc_id", "leaf", "row"])
    base = stored(blocks(placed, ["doc_id", "leaf", "new"], height), "merkle_blocks")

    def roots(batches):
        for b in batches:
            found = [base_nodes(rows["leaf"], levels_in_block(n, height))[-1][0] for _, n, rows in _block_rows(b)]
            yield pa.RecordBatch.from_arrays([b.column("k"), b.column("block"), b.column("n"), pa.array(found, pa.string())],
                                             ["k", "pos", "n", "digest"])

    tops = base.mapInArrow(roots, "k string, pos long, n long, digest string")
    tops = stored(tops.withColumn("n", F.ceil(F.col("n") / FAN ** height)), "merkle_tops")
    within = stored(climb(tops, height), "merkle_within")
    subroots = numbered(within.filter("pos = 0").select(F.col("k").alias("lang"), F.col("top").alias("digest"), F.lit("").alias("k")),
                        "k", ["lang"])
    above = climb(stored(subroots, "merkle_subroots"), height)
    names = siblings_of_groups(subroots, above)
    up = within.join(names, F.col("k").eqNullSafe(F.col("lang"))).select(
        F.col("k").alias("uk"), F.col("pos").alias("upos"), F.col("top").alias("subroot"), "root",
        F.concat("left", "sl").alias("left"), F.concat("right", "sr").alias("right"))
    pages = base.join(up, F.col("k").eqNullSafe(F.col("uk")) & (F.col("block") == F.col("upos"))).select(
        "k", "n", "rows", "subroot", "root", "left", "right")
    id_type = placed.schema["doc_id"].dataType.simpleString()

    def versions(batches):
        for b in batches:
            for i, (k, n, rows) in enumerate(_block_rows(b)):
                subroot, root, left, right = (b.column(c)[i].as_py() for c in ("subroot", "root", "left", "right"))
                yield _version_rows(rows, levels_in_block(n, height), k, subroot, root, list(zip(left, right)),
                                    b.column("rows").type.value_type.field("doc_id").type)

    return pages.mapInArrow(versions, f"doc_id {id_type}, " + ", ".join(f"{c} {t}" for c, t in VERSIONS))


def siblings_of_groups(subroots: DataFrame, above: DataFrame) -> DataFrame:
    """(lang, sl, sr, root): each group's siblings above its subroot."""
    at = above.select(F.col("pos").alias("spos"), F.col("left").alias("sl"), F.col("right").alias("sr"), F.col("top").alias("root"))
    return subroots.join(at, F.col("pos") == F.col("spos")).select("lang", "sl", "sr", "root")


def _version_rows(rows: dict, levels: int, k, subroot: str, root: str, above: list[tuple[str, str]], id_type) -> pa.RecordBatch:
    nodes = base_nodes(rows["leaf"], levels)
    rest = "".join(left + right for left, right in above)
    proofs, folded, copied = [], [], []
    for i, (leaf, new) in enumerate(zip(rows["leaf"], rows["new"])):
        path = siblings(nodes, i)
        proofs.append(digest("".join(left + right for left, right in path) + rest))
        copies = copy_path(path + above, leaf if new is None else new)
        folded.append(copies[-1] if copies else leaf if new is None else new)
        copied.append(None if new is None else copies)
    m = len(proofs)
    columns = [pa.array(rows["doc_id"], id_type), pa.array([k] * m, pa.string()), pa.array(rows["leaf"], pa.string()),
               pa.array([subroot] * m, pa.string()), pa.array([root] * m, pa.string()), pa.array(proofs, pa.string()),
               pa.array(folded, pa.string()), pa.array([f == root for f in folded], pa.bool_()),
               pa.array(copied, pa.list_(pa.string()))]
    return pa.RecordBatch.from_arrays(columns, ["doc_id"] + [c for c, _ in VERSIONS])
