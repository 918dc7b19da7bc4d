"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the hashed words, pairs of neighbouring words and pairs
one word apart, each counted once.  FTRL-proximal keeps a rate per coordinate
and drives weights of uninformative features to exactly zero (L1), so what is
broadcast for scoring is a short list of (cell, weight).

Training: labelled rows are sampled to at most about ``rows_per_label`` rows of
label 0 and 1 (a documented bound on the classifier's sample, by a hash of the
id) and dealt over shards; each shard runs FTRL over its rows, the accumulators of a
cell are averaged over the shards that saw it, and the next round starts from
the average.  The state has 2^18 cells whatever the data.

Nulls, blanks: a null or wordless text has no features and scores the bias.
Rows without a label, or with a null id, are scored and never trained on; of
repeated labels the larger counts.  Without labels all weights are zero and the
score is 0.5.  Repeated rows get equal results; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, drop_checkpoint
from . import common
from .langid import fold

WORD = re.compile(r"[^\W_]+")
CELLS = 1 << 18
BIAS = CELLS


def features(words: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Hash of each word, and the cells of words, pairs and skip-pairs by their first word."""
    h = np.array([zlib.crc32(w.encode()) for w in words], np.uint64)

    def cell(x):
        x = x * np.uint64(0x9E3779B97F4A7C15)
        return ((x ^ x >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(46)).astype(np.int64)
    return h, [cell(h), cell(h[:-1] * np.uint64(1_000_003) + h[1:] + np.uint64(1)),
               cell(h[:-2] * np.uint64(1_000_033) + h[2:] + np.uint64(2))]


def split(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class Ftrl:
    """State (z, n) of FTRL-proximal; the bias is not regularised."""

    def __init__(self, z=None, n=None, alpha=1.0, beta=1.0, l1=4.0, l2=0.1):
        self.z = np.zeros(CELLS + 1) if z is None else z.copy()
        self.n = np.zeros(CELLS + 1) if n is None else n.copy()
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(np.asarray(at) == BIAS, 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, y: int, cost: float = 1.0) -> None:
        w = self.weights(at)
        g = (sigmoid(w.sum()) - y) * (cost if y else 1.0)
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def sample(docs: DataFrame, labels: DataFrame, rows_per_label: tuple[int, int]) -> DataFrame:
    """``(doc_id, text, y)`` of at most about ``rows_per_label`` rows of label 0 and 1."""
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("y")))
    count = {r[0]: r[1] for r in known.filter("y in (0, 1)").groupBy("y").count().collect()}
    take = F.lit(False)
    for y, n in count.items():
        bar = int(min(1.0, rows_per_label[y] / n) * 1_000_000)
        take = take | ((F.col("y") == y) & (F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < bar))
    # the sample is bounded by its parameter, so it may be broadcast
    return common.doc_text(docs).join(F.broadcast(known.filter(take)), "doc_id")


def train(docs: DataFrame, labels: DataFrame, rows_per_label: tuple[int, int] = (12_000, 4000), rounds: int = 3, shards: int = 4,
          epochs: int = 3, miss_cost: float = 1.0) -> tuple[np.ndarray, np.ndarray, float]:
    """(cells, weights, bias) with the zero weights left out; ``miss_cost``: weight of a toxic row."""
    # the sample is bounded, and every round reads it
    rows = cut_lineage(sample(docs, labels, rows_per_label)
                       .withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(shards)).cast("int")))
    state = Ftrl()
    for _ in range(rounds):
        held = docs.sparkSession.sparkContext.broadcast((state.z, state.n))

        def run(t: pa.Table) -> pa.Table:
            f = Ftrl(*held.value)
            ys = t["y"].to_pylist()
            ids = t["doc_id"].to_pylist()
            xs = [np.append(np.unique(np.concatenate(features(split(x))[1])), BIAS) for x in t["text"].to_pylist()]
            for e in range(epochs):
                for i in sorted(range(len(ys)), key=lambda i: (zlib.crc32(f"{e} {ids[i]}".encode()), i)):
                    f.learn(xs[i], ys[i], miss_cost)
            at = np.flatnonzero(f.n)
            return pa.table({"cell": pa.array(at, pa.int64()), "z": f.z[at], "n": f.n[at]})
        mean = (rows.groupBy("shard").applyInArrow(run, "cell bigint, z double, n double")
                .groupBy("cell").agg(F.avg("z").alias("z"), F.avg("n").alias("n")))
        got = mean.toArrow()
        state = Ftrl()
        state.z[got["cell"].to_numpy()] = got["z"].to_numpy()
        state.n[got["cell"].to_numpy()] = got["n"].to_numpy()
    drop_checkpoint(rows)
    w = state.weights(np.arange(CELLS + 1))
    at = np.flatnonzero(w[:CELLS])
    return at, w[at], float(w[BIAS])


def score(docs: DataFrame, weights: tuple[np.ndarray, np.ndarray, float]) -> DataFrame:
    """``(doc_id, score)`` of every row."""
    d = common.doc_text(docs)
    kind = d.schema["doc_id"].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(weights)

    def run(b: pa.RecordBatch) -> dict:
        at, w, bias = held.value
        dense = np.zeros(CELLS)
        dense[at] = w
        words = [split(t) for t in b.column("text").to_pylist()]
        sizes = np.array(list(map(len, words)))
        doc = np.repeat(np.arange(len(words)), sizes)
        _, by = features([x for ws in words for x in ws])
        hits = []
        for gap, c in enumerate(by):
            ok = (dense[c] != 0) & (doc[:len(c)] == doc[gap:gap + len(c)])
            hits.append(doc[:len(c)][ok] * CELLS + c[ok])
        hit = np.unique(np.concatenate(hits))
        total = np.bincount(hit // CELLS, weights=dense[hit % CELLS], minlength=len(words))
        return {"doc_id": b.column("doc_id"), "score": sigmoid(total + bias)}
    return common.map_rows(d, f"doc_id {kind}, score double", run)


def predict_all(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, **how) -> DataFrame:
    """Score every row with weights that never saw a label of the held-out fold."""
    weights = train(docs, labels.filter(~fold("doc_id", folds, held)), **how)
    return score(docs, weights).select("doc_id", fold("doc_id", folds, held).alias("held_out"), "score",
                                       (F.col("score") >= 0.5).cast("int").alias("predicted"))
