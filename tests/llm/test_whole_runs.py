"""Line dedup of whole runs: passages of 2 to 12 lines at random places."""

import random

from chirp.llm import line_dedup as L
from chirp.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.helpers import edge_docs, empty_docs


def test_passages_go_whole_at_any_place(spark):
    rng = random.Random(5)

    def lines(n, w):
        return [" ".join(f"w{rng.randrange(10**9)}" for _ in range(w())) for _ in range(n)]

    rows, want = [], {}
    for n, w in ((2, 30), (3, 20), (4, 15), (6, 10), (8, 7), (12, 10)):
        for _ in range(12):
            passage = lines(n, lambda: w)
            if n == 8:
                passage[3:3] = ["", " "]  # lines without words inside
            for copy in range(3):
                above, below = (lines(rng.randrange(5), lambda: rng.choice((3, 12, 60))) for _ in range(2))
                rows.append((len(rows), "\n".join(above + passage + below)))
                want[len(want)] = "\n".join(above + below) if copy else rows[-1][1]
    rows.append((9000, "a b c d e\n" * 6 + "tail"))  # a run that overlaps itself
    want[9000] = "a b c d e\na b c d e\ntail"
    rows += [(9001, "one two\nthree four"), (9002, "one two\nthree four")]  # under the limits
    want |= {9001: "one two\nthree four", 9002: "one two\nthree four"}
    got = {r["doc_id"]: r for r in L.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), whole=True).collect()}
    assert {i: r["text"] for i, r in got.items()} == want
    assert got[9000]["removed_chunks"] == [2] and got[9000]["n_removed_lines"] == 4 and got[9000]["n_lines"] == 7


def windows(lines):
    """Every run that qualifies and holds no shorter one from the same end."""
    n = [len(x.split()) for x in lines]
    fits = lambda a, b: sum(n[a:b + 1]) >= L.LONG_LINE_WORDS or (
        sum(x > 0 for x in n[a:b + 1]) > 1 and sum(n[a:b + 1]) >= L.MIN_WORDS)
    full = [i for i, x in enumerate(n) if x]
    down = {(a, next((b for b in full if b >= a and fits(a, b)), None)) for a in full}
    up = {(next((a for a in reversed(full) if a <= b and fits(a, b)), None), b) for b in full}
    return sorted(w for w in down | up if None not in w)


def test_query_removes_every_repeated_window(spark):
    docs = sorted((r["doc_id"], r["text"].split("\n")) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    first, want = {}, {}
    for d, lines in docs:
        gone = set()
        for a, b in windows(lines):
            d0, a0, b0 = first.setdefault("\n".join(lines[a:b + 1]), (d, a, b))
            gone |= set(range(a, b + 1)) - (set(range(a0, b0 + 1)) if d0 == d else set())
        want[d] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    got = {r["doc_id"]: r["text"] for r in QUERIES["op10_line_dedup"](spark, SF_SMALL).collect()}
    assert got == want and any(want[d] != "\n".join(x) for d, x in docs)


def test_whole_runs_edges(spark):
    docs = edge_docs(spark)
    out = L.line_dedup(docs, whole=True).collect()
    assert len(out) == docs.count()
    assert all((r["text"] is None) == (r["n_lines"] == 0) for r in out)
    assert L.line_dedup(empty_docs(spark), whole=True).count() == 0


def test_chunks_hold_every_repeated_window_of_line_soups(spark):
    """Texts drawn from few lines, so chunks hold many passages back to back;
    repeated rows among them."""
    rng = random.Random(11)
    pool = ["", " ", "a", "b c d", "e f g h i j", " ".join(f"k{i}" for i in range(12)), " ".join(f"m{i}" for i in range(55))]
    pool += [f"rare {i} x y z" for i in range(60)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(14)))) for i in range(300)]
    first, want = {}, {}
    for d, text in rows:
        lines, gone = text.split("\n"), set()
        for a, b in windows(lines):
            d0, a0, b0 = first.setdefault("\n".join(lines[a:b + 1]), (d, a, b))
            gone |= set(range(a, b + 1)) - (set(range(a0, b0 + 1)) if d0 == d else set())
        want[d] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    got = L.line_dedup(spark.createDataFrame(rows + rows[:20], "doc_id long, text string").repartition(7), whole=True).collect()
    assert len(got) == 320 and all(want[r["doc_id"]] == r["text"] for r in got)
    assert sum(want[d] != t for d, t in rows) > 20


def test_chunk_ends_where_the_rolling_hash_is_alone(spark):
    p, q = [f"p{i} one two three four five" for i in range(4)], [f"q{i} one two three" for i in range(3)]
    rows = [(1, "\n".join(["x"] + p + ["y"])), (2, "\n".join(p + q)), (3, "\n".join(["z", "z2"] + q + ["", "w"])), (4, "w"), (5, None)]
    marks = L.line_marks(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    got = {(r["d"], r["base"], len(r["digests"])) for r in L.chunks_by_rolling_hash(marks).collect()}
    assert got == {(1, 1, 4), (2, 0, 4), (2, 4, 3), (3, 2, 3)}
