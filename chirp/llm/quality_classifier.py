"""Quality classifier: supervised subword embeddings.

Every word is the mean of learned vectors of the hashed word and of its
hashed character n-grams; a document is the mean of its words. Two more
learned vectors count with the words: one for each word equal to the one
before it and one for each word that has stood earlier in the document. A
softmax over the document's vector gives the score; vectors and softmax are
trained together by stochastic gradient descent in numpy.

Fit: labelled rows only, whole texts, at most MAX_PER_CLASS documents of
each class (those of smallest id hash; the parameter bounds what reaches the
driver). The score is corrected by the labels' true class shares. Scoring:
the softmax being linear in the mean, the model is one number per bucket; a
word's number is remembered, and a document costs a look-up per word. Tasks
need the model only (BUCKETS numbers).

Defined cases: a null or empty text has the zero vector and the score of the
bias alone; no labels, or labels of one class only: every score is the share
of label 1 (0.5 without labels); null labels are left out, several labels of
one id are averaged; repeated rows score alike; a null doc_id is never held
out and never learnt from; an empty table gives an empty result. Columns of
``docs`` are carried, those named like an output column are replaced.
"""

from __future__ import annotations

import math
import operator
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirp.llm.common import without

BUCKETS = 1 << 15
NGRAMS = (3, 4, 5)
DIM = 8
STEPS = 12_000
RATE = 0.5
MAX_PER_CLASS = 1000
THRESHOLD = 0.7
SAME, SEEN = BUCKETS, BUCKETS + 1
CACHE_WORDS = 300_000
ADDED = ("held_out", "score", "predicted")


def word_buckets(word: str) -> list[int]:
    """Buckets of the word itself and of its character n-grams."""
    w = f"<{word}>"
    grams = [zlib.crc32(b"=" + word.encode("utf-8", "surrogatepass")) % BUCKETS]
    for n in NGRAMS:
        grams += [zlib.crc32(w[i:i + n].encode("utf-8", "surrogatepass")) % BUCKETS for i in range(len(w) - n + 1)]
    return grams


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, weight) of a document, weights of the mean."""
    words = (text or "").split()
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    at, weight = [], []
    for w, c in counts.items():
        b = word_buckets(w)
        at += b
        weight += [c / len(b)] * len(b)
    at += [SAME, SEEN]
    weight += [sum(map(operator.eq, words, words[1:])), len(words) - len(counts)]
    dense = np.bincount(at, weight, BUCKETS + 2)
    keep = np.flatnonzero(dense)
    return keep, dense[keep] / len(words)


@dataclass
class Model:
    """What scoring needs: a number per bucket and the bias, in log-odds."""
    weights: np.ndarray
    bias: float


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], dim: int = DIM, steps: int = STEPS,
          rate: float = RATE, seed: int = 0) -> Model:
    """SGD over (buckets, weights, label) rows of both classes, one random
    row of either class in turn, with a falling rate; fixed by ``seed``."""
    rng = np.random.default_rng(seed)
    vectors, out = rng.uniform(-1 / dim, 1 / dim, (BUCKETS + 2, dim)), rng.normal(0, 1, (dim, 2))
    bias = np.zeros(2)
    classes = [[r for r in rows if r[2] == c] for c in (0, 1)]
    for step in range(steps):
        part = classes[step % 2]
        at, weight, label = part[rng.integers(len(part))]
        lr = rate * (1 - step / steps)
        hidden = weight @ vectors[at]
        z = hidden @ out + bias
        p = np.exp(z - z.max())
        p /= p.sum()
        p[label] -= 1
        # over the squared weights: a long document's step is not a smaller one
        scale = min(lr / max(float(weight @ weight), 1e-3), 20 * lr)
        back = out @ p
        out -= lr * np.outer(hidden, p)
        bias -= 0.1 * lr * p
        vectors[at] -= np.outer(scale * weight, back)
    side = out[:, 1] - out[:, 0]
    return Model(vectors @ side, float(bias[1] - bias[0]))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        max_per_class: int = MAX_PER_CLASS) -> Model:
    """Learns from the labelled documents that are not held out."""
    y = (labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(doc_id)))
         .groupBy(F.col(doc_id).alias("_c_id")).agg(F.avg(label).alias("y"))
         .select("_c_id", (F.col("y") >= 0.5).cast("int").alias("y")))
    share = {r["y"]: r["n"] for r in y.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(share) < 2:
        p = 0.5 if not share else (1 - 1e-6 if 1 in share else 1e-6)
        return Model(np.zeros(BUCKETS + 2), math.log(p / (1 - p)))
    chosen = None
    for c in (0, 1):
        part = y.filter(F.col("y") == c).orderBy(F.xxhash64("_c_id"), "_c_id").limit(max_per_class)
        chosen = part if chosen is None else chosen.union(part)
    rows = (docs.select(F.col(f"`{doc_id}`").alias("_c_id"), F.col(f"`{text}`").alias("t"))
            .join(F.broadcast(chosen), "_c_id")  # at most 2 * max_per_class ids
            .select("_c_id", "y", "t"))

    def run(batches):
        for b in batches:
            found = [features(t) for t in b.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("_c_id"), b.column("y"),
                 pa.array([f[0].astype("<i4").tobytes() for f in found], pa.binary()),
                 pa.array([f[1].astype("<f4").tobytes() for f in found], pa.binary())], ["id", "y", "at", "weight"])

    kind = rows.schema["_c_id"].dataType.simpleString()
    got = rows.mapInArrow(run, f"id {kind}, y int, at binary, weight binary")
    by_id = {}
    for r in got.toLocalIterator():  # bounded by max_per_class; copies of an id count once
        by_id.setdefault(r["id"], (np.frombuffer(r["at"], "<i4"), np.frombuffer(r["weight"], "<f4").astype(float), r["y"]))
    data = [by_id[k] for k in sorted(by_id)]
    if {d[2] for d in data} != {0, 1}:  # the labels of one class have no documents
        p = float(np.mean([d[2] for d in data])) if data else 0.5
        return Model(np.zeros(BUCKETS + 2), math.log((p + 1e-6) / (1 - p + 1e-6)))
    model = train(data)
    model.bias += math.log(share[1] / share[0])  # the classes took turns
    return model


class _Scores(dict):
    """word -> its number, computed when first met."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights.tolist()

    def __missing__(self, word):
        b = word_buckets(word)
        self[word] = s = sum(map(self.weights.__getitem__, b)) / len(b)
        return s


def score_text(text: str | None, scores: _Scores, bias: float) -> float:
    words = (text or "").split()
    if not words:
        z = bias
    else:
        w = scores.weights
        same = sum(map(operator.eq, words, words[1:]))
        z = bias + (sum(map(scores.__getitem__, words)) + w[SAME] * same + w[SEEN] * (len(words) - len(set(words)))) / len(words)
    z = min(max(z, -500.0), 500.0)
    return 1 / (1 + math.exp(-z))


def classify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text",
             threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` (default: all) with ADDED."""
    base = without(docs, ADDED)
    keep = base.columns if keep is None else keep
    rows = base.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_c_text"))
    weights, bias = model.weights, model.bias

    def run(batches):
        scores = _Scores(weights)
        for b in batches:
            if len(scores) > CACHE_WORDS:
                scores.clear()
            got = [score_text(t.as_py(), scores, bias) for t in b.column("_c_text")]
            n = b.schema.get_field_index("_c_text")
            yield pa.RecordBatch.from_arrays([c for i, c in enumerate(b.columns) if i != n] + [pa.array(got, pa.float64())],
                                             [c for i, c in enumerate(b.schema.names) if i != n] + ["score"])

    schema = T.StructType([f for f in rows.schema.fields if f.name != "_c_text"] + [T.StructField("score", T.DoubleType())])
    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(f"`{c}`") for c in keep], held_out(F.col(f"`{doc_id}`")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
