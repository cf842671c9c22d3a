"""Line dedup (native): content-defined runs of lines.

A repeated run of lines is kept where it occurs first -- smallest doc_id,
then place in the document -- and removed everywhere else. A run qualifies
with at least two lines and MIN_WORDS words, or with LONG_LINE_WORDS words
on any number of lines.

``whole``: a rolling hash runs over the digests of every two neighbouring
lines with words. Where it occurs once in the corpus a chunk ends, so no
boundary ever falls inside a repeated passage, wherever it stands. A chunk may
hold several passages one after the other; it is compared by its shortest
qualifying runs, one down and one up from each line, which cover every
qualifying passage inside it (but empty lines at its edges). A line of
LONG_LINE_WORDS whose own hash repeats is a chunk too. A line goes when it
lies in a run that occurs earlier. Runs that overlap their own first
occurrence leave its lines. The first of all occurrences of a line in the
corpus always stays.

Otherwise (the cheaper cut): a rolling hash over each line and the one
before it decides whether a chunk ends there (on average every CHUNK_LINES
lines), a line of LONG_LINE_WORDS - 1 spaces is a chunk of its own, and only
qualifying chunks are compared; a passage loses only the chunks that lie
inside it.

Equal 64-bit hashes are only candidates: the removal groups by SHA-256, of
the run's bytes or (``whole``) of its lines' SHA-256 in order, so no text
travels.

Plan (``whole``): the texts are read once for their lines' digests, word
counts and rolling hashes, which are stored; hashes are counted with map-side
combination, and the places of repeated ones, one row a document, give the
chunks. The removals, one row a document, are joined back. Hot runs are
combined before the shuffle, and AQE splits the joins' hot keys.

Defined cases: a null text stays null, an empty one empty; a document whose
every line was a repeat keeps its row with an empty text. A null doc_id
orders first. Rows that repeat doc_id and text count as one document and
stay alike. Extra columns are carried; input columns named like an added
column are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirp.llm.common import SPACE, stored, without

CHUNK_LINES = 2
MIN_WORDS = 10
LONG_LINE_WORDS = 50
ADDED = ("n_lines", "n_removed_lines", "removed_chunks")


def _n_words(text: Column) -> Column:
    return F.size(F.filter(F.split(text, SPACE + "+"), lambda w: w != ""))


def with_chunks(df: DataFrame, text: str) -> DataFrame:
    """Adds ``_l_lines`` and ``_l_chunks``: array of (first, n) in lines."""
    df = df.withColumn("_l_lines", F.split(F.col(f"`{text}`"), "\n"))
    df = df.withColumns({
        "_l_hash": F.transform("_l_lines", lambda x: F.xxhash64(x)),
        "_l_long": F.transform("_l_lines", lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) >= LONG_LINE_WORDS - 1)})
    h, lines, long = F.col("_l_hash"), F.col("_l_lines"), F.col("_l_long")
    df = df.withColumn("_l_ends", F.filter(
        F.sequence(F.lit(0), F.size(lines) - 1),
        lambda i: (i == F.size(lines) - 1) | F.get(long, i) | F.coalesce(F.get(long, i + 1), F.lit(False))
        | (F.pmod(F.xxhash64(F.coalesce(F.get(h, i - 1), F.lit(0)), F.get(h, i)), F.lit(CHUNK_LINES)) == 0)))
    ends = F.col("_l_ends")
    first = lambda k: F.coalesce(F.get(ends, k - 1) + 1, F.lit(0))
    return df.withColumn("_l_chunks", F.transform(
        ends, lambda e, k: F.struct(first(k).alias("first"), (e - first(k) + 1).alias("n"))))


def line_marks(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(d, sig, digests, full, marks) per row with a text: SHA-256 of every
    line; line number and words of the lines with words; and the hashes to
    count, (k, h): the rolling hash of the k-th and next line with words (and
    the lines between), or, under -1 - k, the hash of a long k-th line."""
    t = F.col(f"`{text}`")
    df = docs.filter(t.isNotNull()).select(F.col(f"`{doc_id}`").alias("d"), F.xxhash64(t).alias("sig"), F.split(t, "\n").alias("lines"))
    df = df.select("d", "sig", F.transform("lines", lambda x: F.struct(
        F.base64(F.unhex(F.sha2(x, 256))).alias("s"), _n_words(x).alias("w"))).alias("lines"))
    df = df.select("d", "sig", F.col("lines.s").alias("digests"), F.filter(
        F.transform("lines", lambda x, i: F.struct(i.alias("i"), x["w"].alias("w"))), lambda x: x["w"] > 0).alias("full"))
    after = lambda k: F.get(F.col("full"), k + 1)["i"]
    rolling = F.transform("full", lambda x, k: F.struct(
        k.alias("k"), F.when(after(k).isNotNull(), _run_hash(x["i"], after(k) - x["i"] + 1)).alias("h")))
    alone = F.transform("full", lambda x, k: F.struct(
        (-1 - k).alias("k"), F.when(x["w"] >= LONG_LINE_WORDS, _run_hash(x["i"], F.lit(1))).alias("h")))
    return df.withColumn("marks", F.filter(F.concat(rolling, alone), lambda m: m["h"].isNotNull()))


def _run_text(first: Column, n: Column) -> Column:
    return F.array_join(F.slice(F.col("digests"), first + 1, n), "")


def _run_hash(first: Column, n: Column) -> Column:
    return F.xxhash64(_run_text(first, n))


def chunks_by_rolling_hash(marks: DataFrame) -> DataFrame:
    """(d, sig, base, digests, full) per chunk of ``line_marks``: a longest run
    of lines whose rolling hashes all repeat in the corpus, or a repeated long
    line. Line numbers count from ``base``."""
    each = marks.select("d", "sig", F.explode("marks").alias("m")).select("d", "sig", "m.k", "m.h")
    repeated = each.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("h")
    places = (each.join(repeated, "h").groupBy(F.col("d").alias("_d"), F.col("sig").alias("_sig"))
              .agg(F.sort_array(F.collect_set("k")).alias("at")))
    df = marks.drop("marks").join(
        places, F.col("d").eqNullSafe(F.col("_d")) & (F.col("sig") == F.col("_sig"))).drop("_d", "_sig")
    df = df.withColumns({"own": F.filter("at", lambda k: k < 0), "at": F.filter("at", lambda k: k >= 0)})
    breaks = lambda step: F.filter("at", lambda k, j: F.coalesce(F.get("at", j + step) != k + step, F.lit(True)))
    span = lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi"))
    df = df.withColumn("c", F.explode(F.concat(
        F.zip_with(breaks(-1), breaks(1), lambda a, b: span(a, b + 1)), F.transform("own", lambda k: span(-1 - k, -1 - k)))))
    line = lambda k: F.get("full", k)["i"]
    return df.select("d", "sig", line(F.col("c.lo")).alias("base"),
                     F.slice("digests", line(F.col("c.lo")) + 1, line(F.col("c.hi")) - line(F.col("c.lo")) + 1).alias("digests"),
                     F.transform(F.slice("full", F.col("c.lo") + 1, F.col("c.hi") - F.col("c.lo") + 1), lambda x: F.struct(
                         (x["i"] - line(F.col("c.lo"))).alias("i"), x["w"].alias("w"))).alias("full"))


def _end(k: Column, step: int) -> Column:
    """The other end of the shortest qualifying run from the k-th line of
    ``full``; null if the chunk ends before."""
    words = F.get("full", k)["w"]
    out = F.when(words >= LONG_LINE_WORDS, F.get("full", k)["i"])
    for j in range(1, MIN_WORDS):  # each of the lines has a word
        other = F.get("full", k + j * step)
        words = words + other["w"]
        out = out.when(words >= MIN_WORDS, other["i"])
    return out


def _chunk_runs(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(d, sig, first, n, digest) per shortest qualifying run of the chunks."""
    marks = stored(line_marks(docs, doc_id, text), "line_marks")
    run = lambda a, b: F.struct(a.alias("first"), (b - a + 1).alias("n"))
    c = chunks_by_rolling_hash(marks)
    c = c.withColumn("runs", F.array_distinct(F.filter(F.concat(
        F.transform("full", lambda x, k: run(x["i"], _end(k, 1))),
        F.transform("full", lambda x, k: run(_end(k, -1), x["i"]))), lambda w: w["n"].isNotNull())))
    c = c.select("d", "sig", "base", F.explode(F.transform("runs", lambda w: F.struct(
        w["first"].alias("first"), w["n"].alias("n"), F.unhex(F.sha2(_run_text(w["first"], w["n"]), 256)).alias("digest")))).alias("r"))
    return c.select("d", "sig", (F.col("base") + F.col("r.first")).alias("first"), "r.n", "r.digest")


def _small_chunks(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(d, sig, first, n, digest) per qualifying chunk whose hash repeats."""
    t = F.col(f"`{text}`")
    d = with_chunks(docs.select(F.col(f"`{doc_id}`").alias("d"), F.xxhash64(t).alias("sig"), t.alias("t")), "t")
    d = d.select("d", "sig", F.explode(F.transform("_l_chunks", lambda c: F.struct(
        c["first"].alias("first"), c["n"].alias("n"),
        F.array_join(F.slice(F.col("_l_lines"), c["first"] + 1, c["n"]), "\n").alias("body")))).alias("c"))
    body = F.col("c.body")
    # a text of w words has at least 2 w - 1 characters
    d = d.filter(((F.col("c.n") > 1) & (F.length(body) >= 2 * MIN_WORDS - 1)) | (F.length(body) >= 2 * LONG_LINE_WORDS - 1))
    words = _n_words(body)
    sure = (words >= LONG_LINE_WORDS) | ((F.col("c.n") > 1) & (words >= MIN_WORDS))
    occ = d.select("d", "sig", "c.first", "c.n", F.xxhash64(body).alias("h"), F.when(sure, F.unhex(F.sha2(body, 256))).alias("digest"))
    counts = occ.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("h")
    return occ.filter("digest is not null").join(counts, "h").drop("h")


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """(d, sig, drop): per document the numbers of its lines to remove."""
    cand = stored((_chunk_runs if whole else _small_chunks)(docs, doc_id, text), "line_runs")
    place = F.struct("d", "first", "sig")
    # stored, as AQE splits a hot digest only where both sides come straight from a shuffle
    earliest = stored(cand.groupBy("digest").agg(F.min(place).alias("low"), F.max(place).alias("high"))
                      .filter(~F.col("low").eqNullSafe(F.col("high"))).drop("high"), "line_first")
    later = cand.join(earliest, "digest").filter(~place.eqNullSafe(F.col("low")))
    # a run that overlaps its own first occurrence leaves the lines of that
    own = F.col("d").eqNullSafe(F.col("low.d")) & (F.col("sig") == F.col("low.sig"))
    later = later.select("d", "sig", F.when(own, F.greatest("first", F.col("low.first") + F.col("n"))).otherwise(F.col("first")).alias("a"),
                         (F.col("first") + F.col("n") - 1).alias("b"))
    return later.groupBy("d", "sig").agg(F.sort_array(F.array_distinct(F.flatten(
        F.collect_set(F.sequence("a", "b"))))).alias("drop"))


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """``docs`` with repeated runs of lines taken out of ``text`` (``n_chars``,
    if there, is set to the new length) and ADDED: lines before, lines removed,
    first lines of the removed runs."""
    base = without(docs, ADDED)
    gone = removals(base, doc_id, text, whole).select(F.col("d").alias("_l_d"), F.col("sig").alias("_l_sig"),
                                               F.col("drop").alias("_l_drop"))
    t = F.col(f"`{text}`")
    j = base.join(gone, F.col(f"`{doc_id}`").eqNullSafe(F.col("_l_d")) & (F.xxhash64(t) == F.col("_l_sig")), "left")
    # only documents that lose something are cut into lines again
    drop = F.col("_l_drop")
    j = j.withColumn("_l_all", F.split(F.when(drop.isNotNull(), t), "\n"))
    # the kept lines are what lies between two neighbours in the sorted numbers
    edges = F.concat(F.array(F.lit(-1)), drop, F.array(F.size("_l_all")))
    j = j.withColumn("_l_edges", F.when(drop.isNotNull(), edges))
    j = j.withColumn("_l_keep", F.flatten(F.transform("_l_edges", lambda e, k: F.when(
        k > 0, F.slice("_l_all", F.get("_l_edges", k - 1) + 2, e - F.get("_l_edges", k - 1) - 1))
        .otherwise(F.array().cast("array<string>")))))
    kept = F.array_join("_l_keep", "\n")
    new = F.when(drop.isNotNull(), kept).otherwise(t)
    lost = F.size(drop)
    runs = F.filter(drop, lambda i, k: F.coalesce(F.get(drop, k - 1) != i - 1, F.lit(True)))
    cols = []
    for c in base.columns:
        if c == text:
            cols.append(new.alias(c))
        elif c.lower() == "n_chars":
            cols.append(F.when(drop.isNotNull(), F.length(kept).cast("long"))
                        .otherwise(F.col(f"`{c}`").cast("long")).alias(c))
        else:
            cols.append(F.col(f"`{c}`"))
    return j.select(*cols,
                    F.coalesce(F.size(F.split(t, "\n")), F.lit(0)).cast("long").alias("n_lines"),
                    F.coalesce(F.when(drop.isNotNull(), lost), F.lit(0)).cast("long").alias("n_removed_lines"),
                    F.coalesce(runs, F.array().cast("array<int>")).alias("removed_chunks"))
