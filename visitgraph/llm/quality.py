"""Quality classifier: naive-Bayes-scaled n-gram indicators under a linear hinge loss, fitted by dual coordinate descent."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Feature buckets; also the length of the weight vector that goes to the executors (float32: 256 KB).
BUCKETS = 1 << 16
_MIX = np.uint64(0x9E3779B97F4A7C15)
_KIND = np.zeros(256, np.uint8)  # lower, upper, digit, white, other letters' bytes; other signs stand for themselves
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = 1 if "a" <= _c <= "z" else 2 if "A" <= _c <= "Z" else 3 if "0" <= _c <= "9" else 4 if _c in " \t\n\r\v\f" else 5 if _b >= 128 else _b


def _bucket(code: np.ndarray, kind: int) -> np.ndarray:
    """Multiply-shift hash of whole codes of one kind of feature to buckets."""
    return ((code * np.uint64(16) + np.uint64(kind)) * _MIX) >> np.uint64(64 - BUCKETS.bit_length() + 1)


def indicators(text: str | None) -> np.ndarray:
    """Sorted distinct feature buckets of a whole text: byte 3-grams, n-grams of character-kind runs, and repeat levels.

    Null and empty texts have one bucket of their own.
    """
    raw = np.frombuffer((text or "").encode(), np.uint8)
    if not raw.size:
        return np.zeros(1, np.int64)
    seen = np.zeros(BUCKETS, bool)
    b = raw.astype(np.uint64)
    if b.size >= 3:
        seen[_bucket((b[:-2] << np.uint64(16)) | (b[1:-1] << np.uint64(8)) | b[2:], 0)] = True
    kinds = _KIND[raw]
    edge = np.flatnonzero(np.diff(kinds, prepend=255))
    runs = kinds[edge].astype(np.uint64) * np.uint64(4) + np.minimum(np.diff(edge, append=raw.size), 3).astype(np.uint64)
    seen[_bucket(runs, 1)] = True
    if runs.size >= 4:
        seen[_bucket((runs[:-3] << np.uint64(33)) | (runs[1:-2] << np.uint64(22)) | (runs[2:-1] << np.uint64(11)) | runs[3:], 2)] = True
    # how common a kind of run is within the text is an indicator too, in powers of two of its share
    share = np.bincount(runs.astype(np.int64), minlength=1024)
    u = np.flatnonzero(share)
    seen[_bucket(u.astype(np.uint64) * np.uint64(16) + np.minimum(np.log2(runs.size / share[u]), 10).astype(np.uint64), 3)] = True
    white = np.flatnonzero(kinds == 4)
    starts = np.concatenate(([0], white + 1))
    lengths = np.diff(np.concatenate((starts, [raw.size + 1]))) - 1
    w = lengths > 0
    if w.any():
        # a word stands for its length and its first and last bytes here: enough to see a word repeat itself
        first, n = starts[w], lengths[w]
        word = (b[first] << np.uint64(32)) | (b[first + n - 1] << np.uint64(24)) | n.astype(np.uint64)
        same = float(np.mean(word[1:] == word[:-1])) if word.size > 1 else 0.0
        seen[_bucket(np.array([int(same * 10), 100 + int(np.log2(word.size))], np.uint64), 4)] = True
    return np.flatnonzero(seen)


@dataclass
class Model:
    """Linear weights over buckets, an intercept, and the scale that turns margins into probabilities."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, text: str | None) -> float:
        x = indicators(text)
        z = float(self.weights[x].sum()) / np.sqrt(x.size) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * z + self.shift, -30, 30))))


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """min ||w||^2/2 + sum cost * max(0, 1 - y w.x)^1 by its dual, one coordinate at a time; the last weight is the bias."""
    rng, w, bias = np.random.default_rng(seed), np.zeros(BUCKETS), 0.0
    alpha, norm = np.zeros(len(rows)), np.array([float(v @ v) + 1 for v in values])
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            gain = y[i] * (w[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - gain / norm[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
    return w, bias


def fit(texts: list[str | None], labels: list[int], epochs: int = 12, cost: float = 0.5, seed: int = 3) -> Model:
    """The model from labelled texts (1 good). Counts give log ratios r; rows are indicators times r; then hinge loss.

    A fifth of the rows, by position, calibrates the probabilities and is left out of the hinge fit.
    """
    y = np.where(np.asarray(labels) == 1, 1.0, -1.0)
    rows = [indicators(t) for t in texts]
    if len(set(y)) < 2:
        return Model(np.zeros(BUCKETS, np.float32), 0.0, 0.0, 4.0 if (y > 0).any() or not len(y) else -4.0)
    held = np.arange(len(rows)) % 5 == 4
    p, q = np.ones(BUCKETS), np.ones(BUCKETS)
    for x, t, h in zip(rows, y, held, strict=True):
        if not h:
            (p if t > 0 else q)[x] += 1
    r = np.log(p / (1 + (~held & (y > 0)).sum()) / (q / (1 + (~held & (y < 0)).sum())))
    use = np.flatnonzero(~held)
    values = [r[rows[i]] / np.sqrt(rows[i].size) for i in use]
    share = (y[use] > 0).mean()
    w, bias = dual_coordinate_descent([rows[i] for i in use], values, y[use], np.where(y[use] > 0, cost * 0.5 / max(share, 0.01), cost * 0.5 / max(1 - share, 0.01)), epochs, seed)
    weights = (w * r).astype(np.float32)
    z = np.array([float(weights[rows[i]].sum()) / np.sqrt(rows[i].size) + bias for i in np.flatnonzero(held)])
    a, b = platt(z, y[held] > 0)
    return Model(weights, bias, a, b)


def platt(z: np.ndarray, y: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """Slope and shift of a logistic curve through (z, y), by Newton steps with a little shrinkage."""
    if not len(z):
        return 1.0, 0.0
    scale = max(float(np.std(z)), 1e-9)
    x, a, b = z / scale, 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        v = p * (1 - p) + 1e-9
        g = np.array([((p - y) * x).sum() + 0.05 * a, (p - y).sum()])
        h = np.array([[(v * x * x).sum() + 0.05, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-6]])
        d = np.linalg.solve(h, g)
        a, b = a - np.clip(d[0], -1, 1), b - np.clip(d[1], -1, 1)
        if abs(d).max() < 1e-8:
            break
    return float(max(a, 0.0) / scale), float(b)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> tuple[list, list]:
    """Texts and labels of at most ``max_rows`` labelled documents outside the held-out fifth, lowest id hashes first.

    The fold is crc32 of doc_id as text, modulo 5 not 0. Conflicting labels of one document count as the larger one.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & fold).groupBy("doc_id").agg(F.max(label).alias("y"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select("doc_id", "text").join(known, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return [r["text"] for r in rows], [int(r["y"]) for r in rows]


def score_documents(docs: DataFrame, model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col`` (double, 0 to 1) for every whole text; null is scored as empty. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for part in parts:
            yield pd.Series([m.score(None if t is None else t) for t in part], dtype="float64")

    return docs.withColumn(score_col, scored(F.col(text_col)))


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = 6000) -> Model:
    """The quality model from at most ``max_rows`` labelled rows (a bounded sample; the only thing the driver holds)."""
    return fit(*training_rows(docs, labels, "quality", max_rows))


def held_out():
    return (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).alias("held_out")


def op3_quality(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs, model).select("doc_id", held_out(), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
