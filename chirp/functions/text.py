"""Text expressions on tweet columns (E01-E16)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.util import PythonEvalType

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def first_mention(tweet: ColumnOrName, only_retweets: bool = False) -> Column:
    """Handle after the first ``@``: lower-cased, every ``:`` removed.

    Text between the first ``@`` and the next space or ``@``; ``''`` when
    the tweet has no ``@`` (or ``@`` is followed by a space / another
    ``@``); NULL for a NULL tweet. There is no retweet check, so any first
    mention (or an e-mail domain) counts. ``only_retweets`` restricts the
    match to a leading ``RT @``.

    One leftmost regex match; no array is built from the whole text.
    """
    pattern = r"^RT @([^@ ]*)" if only_retweets else r"@([^@ ]*)"
    handle = F.regexp_extract(_c(tweet), pattern, 1)
    return F.replace(F.lower(handle), F.lit(":"), F.lit(""))


def clean_text(tweet: ColumnOrName, strict: bool = False, arrow: bool = False) -> Column:
    """Normalised tweet text (``tweet_parse``).

    Steps: drop every ``RT @``; drop ``http`` up to the next whitespace;
    every character outside ``[a-zA-z0-9@]`` becomes a space (the range
    ``A-z`` also keeps ``[ \\ ] ^ _`` and the backtick; ``strict`` uses
    ``A-Z``); runs of whitespace become one space; lower-case; trim.

    The "outside the class -> space" and "squeeze whitespace" steps are
    fused into one regex pass: the class holds no whitespace, so after
    the first step every whitespace run is a run of replaced characters.
    The class is spelled with ``\\w`` (ASCII ``[a-zA-Z_0-9]`` in Java
    regex) plus the other five characters of ``A-z``: the same set, but
    Java evaluates it about ten times faster than the range union.

    ``arrow`` does the same steps on the bytes of whole Arrow batches, for
    plans that pass the text on to Python in any case.
    """
    if arrow:
        return F.arrow_udf(_arrow_cleaner(strict), "string", PythonEvalType.SQL_SCALAR_ARROW_UDF)(_c(tweet))
    s = F.replace(_c(tweet), F.lit("RT @"), F.lit(""))
    s = F.regexp_replace(s, r"http\S+", "")
    s = F.regexp_replace(s, STRICT_RUN if strict else KEEP_RUN, " ")
    return F.trim(F.lower(s))


# Runs of characters outside the kept class, as Java regex:
# [^a-zA-z0-9@]+ (the reference's class) and [^a-zA-Z0-9@]+ (strict).
KEEP_RUN = r"[^\w@\[\]\\^`]+"
STRICT_RUN = r"[^\p{Alnum}@]+"


HTTP_RUN = re.compile(rb"http[^ \t\n\x0b\f\r\xff]+")


def _arrow_cleaner(strict: bool, rows: int = 1000):
    """``clean_text`` of an Arrow array. What is kept is ASCII, so every step
    works on bytes: the texts are laid end to end with 0xFF between them (a
    byte that UTF-8 does not have), links go, one table lower-cases the kept
    bytes and blanks the others, and a blank stays where a kept byte follows
    and its text has begun."""
    kept = rb"a-zA-Z0-9@" if strict else rb"a-zA-z0-9@"
    is_kept = re.compile(b"[" + kept + b"]").fullmatch
    table = bytes(bytes([c]).lower()[0] if is_kept(bytes([c])) else c if c == 255 else 32 for c in range(256))

    def clean(texts):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        flat = pc.replace_substring(pc.fill_null(texts, "").cast(pa.string()), "RT @", "").cast(pa.binary())
        line = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat), b"\xff")[0].as_py()
        if line.count(b"\xff") != len(flat) - 1:  # not UTF-8
            line = b"\xff".join(t.replace(b"\xff", b"\xfe") for t in flat.to_pylist())
        b = np.frombuffer(HTTP_RUN.sub(b"", line).translate(table) + b"\xff", np.uint8)
        stays = b != 32
        stays[:-1] |= stays[1:] & (b[1:] != 255)
        b = b[stays]
        ends = np.flatnonzero(b == 255)
        starts = np.concatenate(([0], ends[:-1] + 1))
        blank = b[starts] == 32
        stays = np.ones(len(b), np.bool_)
        stays[ends] = False
        stays[starts[blank]] = False
        offsets = np.concatenate(([0], np.cumsum(ends - starts - blank))).astype(np.int32)
        out = pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(b[stays]))
        return pc.if_else(texts.is_valid(), out, pa.scalar(None, pa.string())) if texts.null_count else out

    def cleaned(texts):
        import pyarrow as pa

        parts = [clean(texts.slice(i, rows)) for i in range(0, len(texts), rows)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return cleaned


def flatten_newlines(text: ColumnOrName) -> Column:
    """Newline and carriage return each become a space; tabs are kept.
    (Two byte-level ``replace`` calls: Spark's ``translate`` works per
    character through a lookup map and is many times slower.)"""
    s = F.replace(_c(text), F.lit("\n"), F.lit(" "))
    return F.replace(s, F.lit("\r"), F.lit(" "))


def hashtag_field(tags: ColumnOrName) -> Column:
    """``#a #b`` from an array of tag texts; NULL when there are none."""
    arr = F.filter(_c(tags), lambda t: t.isNotNull())
    joined = F.array_join(F.transform(arr, lambda t: F.concat(F.lit("#"), t)), " ")
    return F.when(F.coalesce(F.size(arr), F.lit(0)) > 0, joined)


def media_field(media: ColumnOrName) -> Column:
    """`` url, url, type`` per media item (missing part -> ``''``), joined
    by spaces; NULL when there are no media items."""
    arr = _c(media)
    item = lambda m: F.concat(
        F.lit(" "), F.coalesce(m["media_url"], F.lit("")), F.lit(", "),
        F.coalesce(m["url"], F.lit("")), F.lit(", "), F.coalesce(m["type"], F.lit("")))
    joined = F.array_join(F.transform(arr, item), " ")
    return F.when(F.coalesce(F.size(arr), F.lit(0)) > 0, joined)


def py_str(x: ColumnOrName) -> Column:
    """Scalar rendered as text the way a Python ``str()`` would: NULL ->
    ``'None'``, booleans -> ``'True'`` / ``'False'``."""
    c = _c(x)
    return F.coalesce(F.initcap(c.cast("string")), F.lit("None"))


def py_str_plain(x: ColumnOrName) -> Column:
    """``str()`` for non-boolean scalars (keeps case)."""
    return F.coalesce(_c(x).cast("string"), F.lit("None"))
