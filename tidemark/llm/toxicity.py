"""Toxicity by a factorization machine over hashed terms.

Terms are a text's lower-case words and their prefixes of 4 to 6 letters, hashed
into 2**20 buckets. The machine's inputs, 1 if present, are all buckets that
depend on the label beyond chance, by a chi-square of at least `significance`;
their number is not capped. Its score is
sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), so pairs such as an
insult with a mention of a group have weights of their own.

It is fitted on a bounded sample of labelled rows (`sample` of each class at
most, by hash of doc_id): buckets are counted on the workers, and only inputs
reach the driver. Every whole text is scored where it is read, without a shuffle. Neither
language, source nor id is an input.

Defined cases: a null or empty text has no terms and gets the machine's bias; a
label table without rows of both classes gives a machine without terms, whose
score is the share of positive labels (0 without any); repeated rows give
repeated rows; null labels and ids are not learned from; where labels repeat an
id, the higher label counts; other columns do not matter. Long texts are read
whole; what is kept of one is at most its distinct buckets, 4 MB.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 20
WORDS = re.compile(r"[^\W\d_]+").findall
PREFIXES = (4, 5, 6)


def buckets(word: str) -> set[int]:
    """Hashed terms of one lower-case word."""
    return {zlib.crc32(f"{k}:{word[:k]}".encode()) % BUCKETS for k in (*(p for p in PREFIXES if len(word) > p), len(word))}


def terms(text: str) -> np.ndarray:
    found: set[int] = set()
    for w in set(WORDS(text.lower())):
        found |= buckets(w)
    return np.fromiter(sorted(found), dtype="<u4", count=len(found))


@dataclass
class Machine:
    """A fitted factorization machine; `index` maps buckets to inputs."""

    bias: float = 0.0
    index: dict[int, int] = field(default_factory=dict)
    linear: np.ndarray = field(default_factory=lambda: np.zeros(0))
    factors: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))

    def __post_init__(self):
        self._words: dict[str, tuple[int, ...]] = {}

    def inputs(self, text: str) -> list[int]:
        known, out = self._words, set()
        for w in set(WORDS(text.lower())):
            hit = known.get(w)
            if hit is None:
                if len(known) > 400_000:
                    known.clear()
                hit = known[w] = tuple(self.index[b] for b in buckets(w) if b in self.index)
            out.update(hit)
        return sorted(out)

    def score(self, text: str) -> float:
        i = self.inputs(text)
        z = self.bias
        if i:
            v = self.factors[i]
            z += float(self.linear[i].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v * v).sum()))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return float(np.log(p / (1 - p)))


def significant(in1: np.ndarray, in0: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Chi-square of presence against label, from the documents of each label that hold a term."""
    has, n = in1 + in0, n1 + n0
    with np.errstate(divide="ignore", invalid="ignore"):
        expected = has * (n1 / n)
        return np.where((has > 0) & (has < n), (in1 - expected) ** 2 / (expected * (1 - has / n) * (n0 / n)), 0.0)


class _Rows:
    """Inputs of the sampled documents as one list of places, row after row."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.n, self.width = len(rows), width
        self.cols = np.concatenate([*rows, np.zeros(0, dtype=np.int64)]).astype(np.int64)
        self.rows = np.repeat(np.arange(self.n), [len(r) for r in rows])

    def dot(self, w: np.ndarray) -> np.ndarray:
        """Each row's sum of its inputs' weights."""
        if w.ndim == 1:
            return np.bincount(self.rows, w[self.cols], self.n)
        return np.stack([self.dot(w[:, k]) for k in range(w.shape[1])], axis=1)

    def back(self, g: np.ndarray) -> np.ndarray:
        """Each input's sum of its rows' values."""
        if g.ndim == 1:
            return np.bincount(self.cols, g[self.rows], self.width)
        return np.stack([self.back(g[:, k]) for k in range(g.shape[1])], axis=1)


def fit(rows: list[tuple[np.ndarray, int]], chosen: np.ndarray, share: float, rank: int = 6, steps: int = 200, seed: int = 7) -> Machine:
    """Fit on (buckets, label) rows over the chosen buckets; share is that of label 1 among all labels, to which the bias returns."""
    y = np.array([r[1] for r in rows], dtype=float)
    if not len(y) or y.min() == y.max():
        return Machine(bias=_logit(share))
    chosen = np.sort(chosen)
    x = _Rows([np.flatnonzero(np.isin(chosen, t, assume_unique=True)) for t, _ in rows], len(chosen))
    rng = np.random.default_rng(seed)
    drawn = _logit(y.mean())
    params = [np.array([drawn]), np.zeros(len(chosen)), rng.normal(0, 0.05, (len(chosen), rank))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):  # Adam on the log loss with weight decay
        b, w, v = params
        xv = x.dot(v)
        z = b[0] + x.dot(w) + 0.5 * ((xv * xv).sum(1) - x.dot((v * v).sum(1)))
        g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(y)
        gx = x.back(g)
        grads = [np.array([g.sum()]), gx + 1e-4 * w, x.back(g[:, None] * xv) - v * gx[:, None] + 1e-3 * v]
        for p, d, m1, m2 in zip(params, grads, first, second):
            m1 += 0.1 * (d - m1)
            m2 += 0.01 * (d * d - m2)
            p -= 0.05 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-9)
    # classes were drawn apart: the bias goes back part of the way to the labels' own share
    return Machine(bias=float(params[0][0]) + min(0.0, _logit(share) - drawn), index={int(b): i for i, b in enumerate(chosen)}, linear=params[1], factors=params[2])


def _presence(texts: DataFrame) -> DataFrame:
    """(bucket, in1, in0): the documents of each label that hold a bucket; each task sums up its own first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, BUCKETS), dtype=np.int64)
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held[toxic, terms(text.as_py() or "")] += 1
        some = np.flatnonzero(held.any(axis=0))
        for at in range(0, len(some), 50_000):
            b = some[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(held[1, b]), pa.array(held[0, b])], names=["bucket", "in1", "in0"])

    return texts.mapInArrow(work, "bucket long, in1 long, in0 long").groupBy("bucket").agg(F.sum("in1").alias("in1"), F.sum("in0").alias("in0"))


def train(docs: DataFrame, labels: DataFrame, sample: int = 4000, significance: float = 8.0, held_out=None) -> Machine:
    """Choose inputs by, and fit on, at most `sample` labelled documents of each class, chosen by hash of their id.

    held_out: a Boolean column over doc_id; rows where it holds are not learned from.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    if held_out is not None:
        known = known.where(~held_out)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    picked = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    picked = F.broadcast(picked[0].unionByName(picked[1]))  # 2 * sample ids
    few = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(picked, "doc_id").select("toxic", "text")
    found = {r["toxic"]: r["n"] for r in few.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(found) < 2:
        return Machine(bias=_logit(share))
    held = _presence(few).where("in1 + in0 >= 3").toArrow()  # one row a bucket at most
    in1, in0 = held["in1"].to_numpy(), held["in0"].to_numpy()
    chosen = held["bucket"].to_numpy()[significant(in1, in0, found[1], found[0]) >= significance]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [np.intersect1d(terms(t.as_py() or ""), chosen).astype("<u4").tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary())], names=["toxic", "terms"])

    rows = few.mapInArrow(work, "toxic int, terms binary").toArrow().sort_by([("toxic", "ascending"), ("terms", "ascending")])
    return fit([(np.frombuffer(t, dtype="<u4"), y) for y, t in zip(rows["toxic"].to_pylist(), rows["terms"].to_pylist())], chosen, share)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, score) of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([machine.score(t.as_py() or "") for t in batch.column(1)], pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, "doc_id long, score double")
