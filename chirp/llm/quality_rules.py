"""Quality rules (native): weak supervision.

Every rule votes good, votes bad or abstains on a document. The rules'
accuracies per class and the share of good documents are estimated by
expectation-maximisation over all documents, and a document is kept when
its posterior probability of being good reaches ``threshold`` (and the
base rules did not fail).

Votes depend on row-local features only; EM runs on the table of distinct
vote patterns (at most 3 ** len(RULES) rows whatever the corpus size). A
round is one aggregate over that table; the driver sees 4 numbers a rule.

Defined cases: a null or empty text has no words, hence base_failed and
not kept. Repeated rows are scored alike and all returned. An empty table
gives an empty result. Input columns named like an output column are
replaced by it; any other extra column is carried. Only row-local work on
the texts, so null ids and ties need no rule.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirp.llm.common import NOT_SPACE, stored, without, words

WINDOW = 5
VOCABULARY_WORDS = 100
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
THRESHOLD = 0.5
ROUNDS = 50
TOLERANCE = 1e-4
# A rate over fewer words says nothing bad of a text: the rules on function
# words and words without letters then abstain.
RATE_WORDS = 30
# EM's start. The ranges only keep the estimates better than chance on good
# documents and the logarithms finite; the rules see the same documents from
# many sides (function words, sentences, marks, case, repetition), so EM finds
# the class of bad documents without being held to it.
START = {"prior": 0.8, "good": 0.95, "bad": 0.4}
GOOD_RANGE, BAD_RANGE = (0.5, 0.9999), (0.01, 0.99)

RULES = ("symbols", "word_length", "capitals", "repetition", "dup_lines", "vocabulary", "shouting",
         "function_words", "sentences", "punct_runs", "bare")
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_block_distinct",
            "n_upper", "n_shouts", "n_function_words", "n_ends", "n_punct_runs", "n_bare")
# Frequent function words of English, French, German, Spanish.
FUNCTION_WORDS = (
    "the", "of", "and", "to", "in", "is", "was", "for", "that", "with", "on", "as", "are", "it", "by", "be", "at",
    "from", "this", "or", "an", "a",
    "le", "la", "les", "et", "des", "du", "de", "un", "une", "est", "en", "que", "qui", "dans", "pour", "par", "sur", "pas",
    "der", "die", "und", "das", "den", "dem", "von", "zu", "mit", "ist", "im", "für", "ein", "eine", "nicht", "auf",
    "el", "los", "las", "y", "del", "se", "por", "con", "una", "es", "lo", "su",
)


def with_features(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) and FEATURES. Each intermediate array
    is a column of its own that several expressions read, so Catalyst does
    not inline it into the lambdas."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = without(docs, FEATURES)
    keep = base.columns if keep is None else keep
    d = base.select(*[F.col(f"`{c}`") for c in keep], t.alias("_q_t"))
    d = d.withColumns({
        "_q_w": words(F.col("_q_t")),
        "_q_l": F.filter(F.split("_q_t", "\n"), lambda x: x.rlike(NOT_SPACE)),
    })
    d = d.withColumn("_q_h", F.transform("_q_w", lambda w: F.xxhash64(w)))
    h = F.col("_q_h")
    d = d.withColumn("_q_g", F.when(
        F.size(h) >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW),
                    lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])))
        .otherwise(F.array().cast("array<bigint>")))
    g = F.col("_q_g")
    # Windows sorted by hash, only where some window occurs twice.
    d = d.withColumn("_q_s", F.when(
        F.size(F.array_distinct(g)) < F.size(g),
        F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col("_q_s")
    d = d.withColumn("_q_p", F.array_sort(F.transform(
        F.filter(s, lambda x, j: F.coalesce((x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]),
                                            x["h"] == F.get(s, j - 1)["h"], x["h"] == F.get(s, j + 1)["h"],
                                            F.lit(False))),
        lambda x: x["i"])))
    p = F.col("_q_p")
    covered = F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))),
                          F.lit(0), lambda a, x: a + x)
    # distinct words of each VOCABULARY_WORDS words, as the share of a whole text falls with its length
    last = F.greatest(F.floor((F.size(h) - 1) / VOCABULARY_WORDS), F.lit(0)).cast("int")
    d = d.withColumn("_q_b", F.transform(F.sequence(F.lit(0), last), lambda i: F.size(
        F.array_distinct(F.slice(h, i * VOCABULARY_WORDS + 1, VOCABULARY_WORDS)))))
    n = lambda c: c.cast("long")
    return d.select(
        *[F.col(f"`{c}`") for c in keep],
        n(F.size("_q_w")).alias("n_words"),
        n(F.length(F.array_join("_q_w", ""))).alias("word_chars"),
        n(F.regexp_count("_q_t", F.lit("[#*$%&|<>]"))).alias("n_symbols"),
        n(F.size("_q_l") - F.size(F.array_distinct("_q_l"))).alias("n_dup_lines"),
        n(F.coalesce(covered, F.lit(0))).alias("n_repeat_words"),
        n(F.size("_q_l")).alias("n_lines"),
        n(F.aggregate("_q_b", F.lit(0), lambda a, x: a + x)).alias("n_block_distinct"),
        n(F.regexp_count("_q_t", F.lit("\\p{Lu}"))).alias("n_upper"),
        n(F.regexp_count("_q_t", F.lit("[!?]"))).alias("n_shouts"),
        n(F.size(F.filter("_q_w", lambda w: F.lower(w).isin(*FUNCTION_WORDS)))).alias("n_function_words"),
        n(F.regexp_count("_q_t", F.lit("[.!?](?=\\s|\\z)"))).alias("n_ends"),
        n(F.regexp_count("_q_t", F.lit("[^\\p{L}\\p{N}\\s]{2,}"))).alias("n_punct_runs"),
        n(F.regexp_count("_q_t", F.lit("(?<![^ \\t-\\r])[^\\p{L} \\t-\\r]++(?![^ \\t-\\r])"))).alias("n_bare"))


def _rules() -> dict[str, tuple[Column, Column]]:
    """name -> (votes bad, votes good); neither: abstains."""
    c = F.col
    w = c("n_words")
    return {
        "symbols": (c("n_symbols") * 20 > c("word_chars"), c("n_symbols") * 200 <= c("word_chars")),
        "word_length": ((c("word_chars") > 10 * w) | (c("word_chars") < 3 * w),
                        (c("word_chars") >= 4 * w) & (c("word_chars") <= 7 * w)),
        "capitals": (c("n_upper") * 10 > 3 * c("word_chars"), c("n_upper") * 10 <= c("word_chars")),
        "repetition": (c("n_repeat_words") * 10 > w, c("n_repeat_words") * 50 <= w),
        "dup_lines": (c("n_dup_lines") * 2 > c("n_lines"), c("n_dup_lines") * 5 <= c("n_lines")),
        "vocabulary": ((w >= 50) & (c("n_block_distinct") * 10 < 3 * w), c("n_block_distinct") * 2 >= w),
        "shouting": (c("n_shouts") * 5 > w, c("n_shouts") * 20 <= w),
        "function_words": ((w >= RATE_WORDS) & (c("n_function_words") * 20 < w), c("n_function_words") * 8 >= w),
        "sentences": (c("n_ends") * 100 < w, (c("n_ends") * 30 >= w) & (c("n_ends") * 3 <= w)),
        "punct_runs": (c("n_punct_runs") * 10 > w, c("n_punct_runs") * 50 <= w),
        "bare": ((w >= RATE_WORDS) & (c("n_bare") * 4 > w), c("n_bare") * 10 <= w),
    }


def votes() -> list[Column]:
    """One vote a rule: 1 good, -1 bad, 0 abstains. A document without
    words gets no votes."""
    out = []
    for name, (bad, good) in _rules().items():
        out.append(F.when(F.col("n_words") == 0, 0).when(bad, -1).when(good, 1).otherwise(0)
                   .cast("int").alias(f"vote_{name}"))
    return out


def posterior(model: dict) -> Column:
    """P(good | votes) under independent rules, as one expression. The
    weights are one array literal, which generated code takes as a
    reference: the rounds of EM share one compiled plan."""
    weights = [math.log(model["prior"] / (1 - model["prior"]))]
    for name in RULES:
        good, bad = model["good"][name], model["bad"][name]
        weights += [math.log(good / (1 - bad)), math.log((1 - good) / bad)]
    w = F.lit(weights)
    logit = F.get(w, F.lit(0))
    for i, name in enumerate(RULES):
        v = F.col(f"vote_{name}")
        logit = logit + (F.when(v == 1, F.get(w, F.lit(2 * i + 1)))
                         .when(v == -1, F.get(w, F.lit(2 * i + 2))).otherwise(F.lit(0.0)))
    return 1 / (1 + F.exp(-logit))


def fit(patterns: DataFrame, rounds: int = ROUNDS) -> dict:
    """EM over (vote_*, n) rows. ``good[r]``: chance that rule r, voting on a
    good document, says good; ``bad[r]``: on a bad one, says bad. Counts are
    smoothed by one of each vote; GOOD_RANGE and BAD_RANGE bound the
    estimates. No rows: the start values."""
    held = lambda x, limits: min(max(x, limits[0]), limits[1])
    model = {"prior": START["prior"], "good": dict.fromkeys(RULES, START["good"]),
             "bad": dict.fromkeys(RULES, START["bad"])}
    for _ in range(rounds):
        p = patterns.withColumn("_g", posterior(model) * F.col("n")).withColumn("_b", F.col("n") - F.col("_g"))
        sums = [F.sum("_g").alias("g"), F.sum("_b").alias("b")]
        for name in RULES:
            v = F.col(f"vote_{name}")
            sums += [F.sum(F.when(v == 1, F.col("_g"))).alias(f"gg_{name}"),
                     F.sum(F.when(v != 0, F.col("_g"))).alias(f"gn_{name}"),
                     F.sum(F.when(v == -1, F.col("_b"))).alias(f"bb_{name}"),
                     F.sum(F.when(v != 0, F.col("_b"))).alias(f"bn_{name}")]
        r = p.agg(*sums).first()  # one row of 4 numbers a rule
        if r["g"] is None:
            return model
        new = {"prior": (r["g"] + 1) / (r["g"] + r["b"] + 2),
               "good": {k: held(((r[f"gg_{k}"] or 0) + 1) / ((r[f"gn_{k}"] or 0) + 2), GOOD_RANGE) for k in RULES},
               "bad": {k: held(((r[f"bb_{k}"] or 0) + 1) / ((r[f"bn_{k}"] or 0) + 2), BAD_RANGE) for k in RULES}}
        moved = max([abs(new["prior"] - model["prior"])]
                    + [abs(new[s][k] - model[s][k]) for s in ("good", "bad") for k in RULES])
        model = new
        if moved < TOLERANCE:
            break
    return model


OUTPUT = FEATURES + tuple(f"vote_{r}" for r in RULES) + ("base_failed", "quality_posterior", "kept")


def quality_rules(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
                  threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns of ``docs`` (default: all) with OUTPUT. Features and
    votes are computed once and stored in the shared scratch folder; EM and
    the verdicts read them from there."""
    base = without(docs, OUTPUT)
    scored = stored(with_features(base, text, keep).select("*", *votes()), "quality_votes")
    names = [f"vote_{r}" for r in RULES]
    patterns = stored(scored.groupBy(*names).agg(F.count(F.lit(1)).alias("n")), "quality_patterns")
    model = fit(patterns)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (scored.withColumn("base_failed", failed)
            .withColumn("quality_posterior", posterior(model))
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality_posterior") >= threshold)))
