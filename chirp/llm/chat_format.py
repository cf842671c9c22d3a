"""Chat formatting (native): event-sourced reconstruction.

The input is a log of events (conv_id, seq, msg, kind, role, text). Events
are partitioned by conversation and sorted by seq; each message's events
are folded into its final text:

* ``message``, ``edit``   the text becomes this event's text
* ``delta``               this event's text is appended
* ``regenerate``          the text starts anew (with this event's text)

The last role given holds. Messages stand in the order of their first
event (seq, then msg). Folding is per message first, so a conversation's
row only ever gathers final messages.

Template: ``<|im_start|>`` role newline text ``<|im_end|>`` newline.
Control strings inside texts and roles get a backslash after their first
character (one more if some are there already), so none is left and the
escape can be undone; backslashes and newlines in roles are written ``\\\\``
and ``\\n``. ``loss_spans`` are the [start, end) code points of the
assistant texts in ``formatted``.

Defined cases: null texts and roles are empty; a null seq sorts first; an
unknown or null kind counts as ``message``; conversations with a null id
form one conversation; events equal in seq are folded in the order of
(kind, role, text), repeated rows included. An empty log gives an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, END = "<|im_start|>", "<|im_end|>"
# Control strings of common chat templates; fixed values.
_CONTROL = "(/?(?:s>|INST\\]|<SYS>>|/SYS>>)|\\|[A-Za-z_]+\\|>)"
ESCAPE = "([<\\[])(\\\\*)" + _CONTROL
UNESCAPE = "([<\\[])\\\\(\\\\*)" + _CONTROL
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, "$1\\\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


def _role_out(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _role_in(role: Column) -> Column:
    parts = F.split(unescape(role), "\\\\\\\\")  # between escaped backslashes
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, seq, msg, role, text): a row for each final message."""
    e = events.select(
        "conv_id", "msg",
        F.struct(F.col("seq"), F.coalesce("kind", F.lit("message")).alias("kind"),
                 F.col("role"), F.coalesce("text", F.lit("")).alias("text")).alias("e"))
    g = e.groupBy("conv_id", "msg").agg(F.sort_array(F.collect_list("e")).alias("log"))
    start = F.struct(F.lit(None).cast("string").alias("role"), F.lit("").alias("text"))
    final = F.aggregate("log", start, lambda a, x: F.struct(
        F.coalesce(x["role"], a["role"]).alias("role"),
        F.when(x["kind"] == "delta", F.concat(a["text"], x["text"])).otherwise(x["text"]).alias("text")))
    return (g.select("conv_id", "msg", F.get("log", F.lit(0))["seq"].alias("seq"), final.alias("m"))
            .select("conv_id", "seq", "msg", F.coalesce("m.role", F.lit("")).alias("role"), F.col("m.text").alias("text")))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans), a row for each conversation."""
    m = messages.select("conv_id", "seq", "msg", "role",
                        F.concat(F.lit(START), _role_out(F.col("role")), F.lit("\n")).alias("head"),
                        escape(F.col("text")).alias("body"))
    g = m.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("seq", "msg", "role", "head", "body"))).alias("m"))
    tail = END + "\n"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(a, x):
        begin = a["at"] + F.length(x["head"])
        end = begin + F.length(x["body"])
        spans = F.when(x["role"] == LOSS_ROLE, F.concat(a["spans"], F.array(
            F.struct(begin.alias("start"), end.alias("end"))))).otherwise(a["spans"])
        return F.struct((end + len(tail)).alias("at"), spans.alias("spans"))

    return g.select("conv_id",
                    F.array_join(F.transform("m", lambda x: F.concat(x["head"], x["body"], F.lit(tail))), "").alias("formatted"),
                    F.aggregate("m", zero, step)["spans"].alias("loss_spans"))


def format_chats(events: DataFrame) -> DataFrame:
    return render(fold(events))


def parse(formatted: Column) -> Column:
    """The (role, text) messages of a rendered conversation, unescaped."""
    blocks = F.slice(F.split(formatted, "<\\|im_start\\|>"), 2, 1 << 30)

    def one(b):
        body = F.substring(b, F.lit(1), F.length(b) - len(END) - 1)
        cut = F.instr(body, "\n")
        return F.struct(_role_in(F.substring(body, F.lit(1), cut - 1)).alias("role"),
                        unescape(F.substring(body, cut + 1, F.length(body))).alias("text"))

    return F.transform(blocks, one)


def conversation_events(conversations: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) as ``message`` events, each its
    own message even if its turn is repeated (ties: role, text)."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select("conv_id", F.col("turn").alias("seq"), F.row_number().over(w).alias("msg"),
                                F.lit("message").alias("kind"), "role", "text")
