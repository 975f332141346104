"""Toxic documents by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the presence of its words, its word pairs and its pairs with one
word skipped, hashed to DIM places.  Training follows McMahan et al., "Ad Click Prediction:
a View from the Trenches" (2013): per-coordinate learning rates and L1 sparsity, so most
weights are exactly zero and the model is a short list of (place, weight) that is sent with
the tasks.  Scoring is one pass over the whole texts without a shuffle.

Training uses at most SAMPLE labelled rows, half for each class, taken by the hash of their
id; a fifth of them is held out to set the threshold with the classes weighted back to their
share of all labels: the best F1 among those thresholds above which most documents are toxic,
and none where there is no such threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textkit as tk
from tidemark.llm.common import fresh

SAMPLE = 16_000
DIM = 1 << 20
#: L1 alone keeps rare features out; the model has at most DIM weights, 8 MB, whatever the corpus.
ALPHA, BETA, L1, L2, EPOCHS = 0.3, 1.0, 20.0, 1.0, 6


def features(texts: pa.Array, dim: int = DIM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place) of every feature occurrence, unsorted, and the words of each text."""
    w = tk.words_of(texts)
    h, doc = w.hash, w.doc
    parts, owners = [h], [doc]
    for gap in (1, 2):
        if len(h) > gap:
            same = doc[gap:] == doc[:-gap]
            parts.append(tk.mix64(h[:-gap] * np.uint64(2 * gap + 1) + tk.mix64(h[gap:] + np.uint64(gap)))[same])
            owners.append(doc[:-gap][same])
    return np.concatenate(owners), (np.concatenate(parts) & np.uint64(dim - 1)).astype(np.int64), np.diff(w.first)


def ftrl(examples: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, dim: int, l1: float, epochs: int, alpha: float = ALPHA, beta: float = BETA, l2: float = L2) -> np.ndarray:
    """Weights after FTRL-proximal passes over the examples (places; the last place is the bias)."""
    z, n = np.zeros(dim + 1), np.zeros(dim + 1)

    def at(x: np.ndarray) -> np.ndarray:
        zx = z[x]
        v = (np.sign(zx) * l1 - zx) / ((beta + np.sqrt(n[x])) / alpha + l2)
        v[np.abs(zx) <= l1] = 0.0
        if x[-1] == dim:  # the bias isn't regularised
            v[-1] = -zx[-1] / ((beta + np.sqrt(n[dim])) / alpha)
        return v

    for _ in range(epochs):
        for x, y, c in zip(examples, labels, weights):
            v = at(x)
            g = c * (1.0 / (1.0 + np.exp(-np.clip(v.sum(), -35, 35))) - y)
            root = np.sqrt(n[x])
            n[x] += g * g
            z[x] += g - (np.sqrt(n[x]) - root) / alpha * v
    out = np.zeros(dim + 1)
    every = np.append(np.flatnonzero(n[:dim]), dim)
    out[every] = at(every)
    return out


@dataclass
class Model:
    places: np.ndarray
    values: np.ndarray
    bias: float
    threshold: float

    def dense(self) -> np.ndarray:
        out = np.zeros(DIM, np.float32)
        out[self.places] = self.values
        return out


def _margins(dense: np.ndarray, bias: float, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(margin, words) of each text; each feature counts once a text."""
    doc, place, words = features(texts)
    v = dense[place]
    hit = np.flatnonzero(v)
    pair = np.unique(doc[hit] * DIM + place[hit])
    return np.bincount(pair // DIM, weights=dense[pair % DIM], minlength=len(texts)) + bias, words


def _train(epochs: int, l1: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xs: list[np.ndarray] = []
        ys, us, hs, texts = [], [], [], []
        for batch in batches:
            for at, part in tk.chunked(batch.column(0)):
                doc, place, _ = features(part)
                pair = np.unique(doc * DIM + place)
                cut = np.searchsorted(pair, np.arange(len(part) + 1) * DIM)
                for k in range(len(part)):
                    xs.append(np.append((pair[cut[k] : cut[k + 1]] % DIM).astype(np.int32), np.int32(DIM)))
            ys.append(batch.column(1).to_numpy())
            us.append(batch.column(2).to_numpy())
            hs.append(batch.column(3).to_numpy())
        if not xs:
            return
        y, u, order = np.concatenate(ys).astype(float), np.concatenate(us), np.concatenate(hs)
        held = order % 5 == 0
        turn = np.argsort(order, kind="stable")
        fit = [i for i in turn if not held[i]]
        if len(set(y[fit])) < 2:
            return
        w = ftrl([xs[i] for i in fit], y[fit], np.ones(len(fit)), DIM, l1, epochs)
        places = np.flatnonzero(w[:DIM])
        test = np.flatnonzero(held) if len(set(y[held])) == 2 else np.arange(len(xs))
        margin = np.array([w[xs[i]].sum() for i in test])
        best = np.argsort(-margin, kind="stable")
        tp = np.cumsum(u[test][best] * y[test][best])
        fp = np.cumsum(u[test][best] * (1 - y[test][best]))
        f1 = 2 * tp / (tp + fp + (u[test] * y[test]).sum())
        # a threshold above which most documents aren't toxic is none: a model that learnt nothing flags nothing
        fair = np.append(np.diff(margin[best]) < 0, True) & (tp > fp)
        k = int(np.argmax(np.where(fair, f1, -1)))
        # midway to the next lower margin, so that the threshold isn't a document's own score
        cut = float("inf") if not fair.any() else (margin[best][k] + margin[best][k + 1]) / 2 if k + 1 < len(best) else margin[best][k] - 1e-6
        yield pa.RecordBatch.from_pydict({"places": [places.astype(np.int32)], "weights": [w[places].astype(np.float32)], "bias": [float(w[DIM])], "cut": [float(cut)], "f1": [float(f1[k])]})

    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, epochs: int = EPOCHS, l1: float = L1) -> Model | None:
    """The model, or None where the labelled rows don't show both classes.

    Of labels that repeat an id the largest counts; null labels and ids don't.
    """
    kind = dict(docs.dtypes)[id_col]
    own = labels.select(F.col(f"`{id_col}`").cast(kind).alias("id"), F.col(f"`{label_col}`").cast("int").alias("y")).where("id IS NOT NULL AND y IS NOT NULL")
    own = own.groupBy("id").agg((F.max("y") > 0).cast("int").alias("y")).withColumn("h", F.xxhash64("id"))
    total = {r["y"]: r["count"] for r in own.groupBy("y").count().collect()}
    if len(total) < 2:
        return None
    half = sample // 2
    weight = {y: max(1.0, n / half) for y, n in total.items()}
    taken = [own.where(f"y = {y}").orderBy("h", "id").limit(half).withColumn("u", F.lit(weight[y])) for y in (0, 1)]
    chosen = taken[0].unionByName(taken[1])
    text = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("text IS NOT NULL")
    rows = text.join(F.broadcast(chosen), "id").select("text", "y", "u", F.expr("pmod(h, 9223372036854775807)").alias("h"))
    found = rows.repartition(1).sortWithinPartitions("h", "text").mapInArrow(_train(epochs, l1), "places array<int>, weights array<float>, bias double, cut double, f1 double").collect()
    if not found:
        return None
    r = found[0]
    return Model(np.array(r["places"], np.int64), np.array(r["weights"], np.float32), r["bias"], r["cut"])


def score(model: Model | None, text: Column) -> Column:
    """struct(score, toxic) of a text: the model's probability, and whether it is at the threshold or above.
    Null texts, texts without words, and every text where there is no model, are 0 and false."""
    if model is None:
        return F.struct(F.lit(0.0).alias("score"), F.lit(False).alias("toxic"))
    cache: list[np.ndarray] = []

    @F.arrow_udf("struct<score double, toxic boolean>")
    def judge(texts: pa.Array) -> pa.Array:
        if not cache:
            cache.append(model.dense())
        p, toxic = np.zeros(len(texts)), np.zeros(len(texts), bool)
        for at, part in tk.chunked(texts):
            m, words = _margins(cache[0], model.bias, part)
            some = words > 0
            p[at : at + len(part)] = np.where(some, 1 / (1 + np.exp(-np.clip(m, -700, 700))), 0.0)
            toxic[at : at + len(part)] = some & (m >= model.threshold)
        return pa.StructArray.from_arrays([pa.array(p), pa.array(toxic)], ["score", "toxic"])

    return judge(text.cast("string"))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, score, toxic) for every row of docs, repeated rows and rows without an id too.

    Null, empty, blank and word-free texts score 0 and aren't toxic; texts are read whole, however long.  A document
    is toxic from the threshold on, ties with it included.  Ids may be of any type; labels are matched by id.  Where
    the labels don't show both classes nothing is toxic.  An empty table gives an empty result; other columns of docs
    and labels aren't read, whatever their names.
    """
    model = train(docs, labels, id_col, text_col, **options)
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), score(model, F.col(f"`{text_col}`")).alias("s")).select("doc_id", "s.score", "s.toxic")


def drop_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of docs, all columns kept, that `toxicity` doesn't call toxic: each repeated row and each row without
    an id is judged by its own text; null, empty and word-free texts stay.  Without labels of both classes every row
    stays; an empty table stays empty; other columns may have any name."""
    model = train(docs, labels, text_col=text_col, **options)
    (name,) = fresh(docs, "tm_toxic")
    return docs.withColumn(name, score(model, F.col(f"`{text_col}`"))["toxic"]).where(~F.col(name)).drop(name)
