"""Toxicity by compression distance: windows compressed with a toxic and with an ordinary zstandard dictionary."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitgraph.llm.quality import held_out, score_documents, training_rows

LEVEL, MIN_MATCH = 12, 4


def windows(text: str | None, size: int) -> list[bytes]:
    """A whole text in lower case, cut between words into runs of at most ``size`` bytes (longer words are cut)."""
    out, run, n = [], [], 0
    for word in (text or "").lower().encode().split():
        while len(word) > size:
            out.append(word[:size])
            word = word[size:]
        if n + len(word) + 1 > size and run:
            out.append(b" ".join(run))
            run, n = [], 0
        run.append(word)
        n += len(word) + 1
    if run:
        out.append(b" ".join(run))
    return out


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    """Uses the dictionary's content alone: with no entropy tables of their own, lengths differ by what was found in it."""
    d = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    params = zstandard.ZstdCompressionParameters.from_level(LEVEL, min_match=MIN_MATCH, write_content_size=False, write_checksum=False, write_dict_id=False)
    d.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=params)


def lengths(c: zstandard.ZstdCompressor, parts: list[bytes]) -> np.ndarray:
    one = c.compress
    return np.fromiter((len(one(p)) for p in parts), np.int32, len(parts))


@dataclass
class Model:
    """Both dictionaries, and the calibration of a text's window gains; without dictionaries every score is the prior."""

    toxic: bytes
    ordinary: bytes
    size: int
    weights: tuple[float, ...]
    prior: float
    _made: tuple | None = None

    def __getstate__(self):
        return self.__dict__ | {"_made": None}

    def gains(self, parts: list[bytes]) -> np.ndarray:
        """Bytes that the toxic dictionary saves over the ordinary one, by window."""
        self._made = self._made or (_compressor(self.ordinary), _compressor(self.toxic + self.ordinary))
        return lengths(self._made[0], parts) - lengths(self._made[1], parts)

    def score(self, text: str | None) -> float:
        if not self.toxic or not (text or "").strip():
            return self.prior
        z = features(self.gains(windows(text, self.size))) @ np.asarray(self.weights[:-1]) + self.weights[-1]
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def features(gains: np.ndarray) -> np.ndarray:
    """The three largest gains of a text, how many reach 2, 3, 4 and 6 bytes against its length, and its length."""
    top = np.zeros(3)
    g = np.sort(gains)[::-1][:3]
    top[: g.size] = np.maximum(g, 0)
    return np.array([*top, *((gains >= t).sum() / np.sqrt(len(gains) + 4) for t in (2, 3, 4, 6)), np.sqrt(len(gains))])


def train(parts: list[bytes], size: int) -> bytes:
    """A zstandard dictionary of at most ``size`` bytes from windows, with the spaces around them; empty if its trainer has too few."""
    parts = [b" " + p + b" " for p in parts]
    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, parts)) // 2)), parts, k=16, d=8, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def telling(dictionary: bytes, toxic: list[bytes], ordinary: list[bytes], base: bytes, piece: int = 16, least: float = 3.0, times: float = 4.0) -> bytes:
    """Those pieces of a toxic dictionary that alone save more on toxic windows than on ordinary ones, the best last.

    A piece stays if its mean saving is ``least`` standard errors above that on ordinary windows, and ``times`` it.
    """
    plain = _compressor(base)
    before, usual = lengths(plain, toxic), lengths(plain, ordinary)
    good = []
    for at in range(0, len(dictionary) - piece + 1, piece // 2):
        part = dictionary[at : at + piece]
        c = _compressor(part + base)
        saved = before - lengths(c, toxic)
        if (saved > 0).sum() < 3:
            continue
        lost = usual - lengths(c, ordinary)
        z = (saved.mean() - lost.mean()) / np.sqrt(saved.var() / len(saved) + lost.var() / len(lost) + 1e-9)
        if z >= least and saved.mean() > times * max(lost.mean(), 0.0):
            good.append((z, part))
    return b"".join(part for _, part in sorted(good))


def fit(texts: list[str | None], labels: list[int], size: int = 96, dictionary: int = 4096, common: int = 65536, rounds: int = 8, keep: int = 3, seed: int = 5, max_windows: int = 40_000, checked: int = 2000, balance: float = 0.75) -> Model:
    """The model from labelled texts (1 toxic).

    A toxic text is mostly ordinary prose: its label says that some window is toxic. So toxic texts are halved, and in
    each of ``rounds`` a dictionary trained on the windows of one half chooses the other half's: the ``keep`` windows
    of each text on which it saves most over the ordinary dictionary (trained on at most ``max_windows`` ordinary
    windows, drawn at random). What both halves share comes through. The toxic dictionary, at most ``dictionary`` bytes,
    is trained on the windows chosen last; its ``telling`` pieces stay, held against ``checked`` ordinary windows.

    Every fifth text only calibrates: a logistic fit on its windows' gains, toxic texts weighing more by the class
    ratio to the power ``balance``. The bounds are on what is fitted, never on what is scored. With one class only, or
    too little text for the trainer (a warning tells), every score is the share of toxic texts.
    """
    y = np.asarray(labels) == 1
    prior = float(y.mean()) if len(y) else 0.0
    none = Model(b"", b"", size, (), prior)

    def untrained(why: str) -> Model:
        warnings.warn(f"no dictionary: {why}; every score is {prior}", stacklevel=3)
        return none

    if len(set(y)) < 2:
        return untrained("labels of one class only")
    held = np.arange(len(texts)) % 5 == 4
    parts = [windows(t, size) for t in texts]
    rng = np.random.default_rng(seed)
    plain = [w for ws, bad, h in zip(parts, y, held, strict=True) if not bad and not h for w in ws]
    plain = [plain[i] for i in rng.permutation(len(plain))[:max_windows]]
    base = train(plain, common)
    bad = [i for i in range(len(texts)) if y[i] and not held[i]]
    if not base or len(bad) < 2 or len(set(y[held])) < 2:
        return untrained("too few labelled texts")
    usual = _compressor(base)
    before = {i: lengths(usual, parts[i]) for i in bad}
    chosen = {i: parts[i] for i in bad}
    for _ in range(rounds):
        other = [train([w for i in bad[1 - h :: 2] for w in chosen[i]], dictionary) for h in (0, 1)]
        if not all(other):
            return untrained("too few toxic windows")
        new = {}
        for h in (0, 1):
            c = _compressor(other[h] + base)
            for i in bad[h::2]:
                saved = before[i] - lengths(c, parts[i])
                new[i] = [parts[i][j] for j in np.argsort(-saved, kind="stable")[:keep] if saved[j] > 0]
        chosen = new
    toxic = [w for i in bad for w in chosen[i]]
    found = train(toxic, dictionary) if toxic else b""
    found = telling(found, toxic, plain[:checked], base[-8192:]) if found else b""
    if not found:
        return untrained("no piece of it tells toxic from ordinary windows")
    out = Model(found, base, size, (), prior)
    x = np.array([features(out.gains(parts[i])) for i in np.flatnonzero(held)])
    out.weights = tuple(map(float, logistic(x, y[held], balance)))
    return out


def logistic(x: np.ndarray, y: np.ndarray, balance: float, steps: int = 300) -> np.ndarray:
    """Weights and intercept of a logistic fit with a little shrinkage, the rarer class weighing more."""
    a = np.column_stack((x, np.ones(len(x))))
    scale = np.append(np.maximum(x.std(axis=0), 1e-9), 1.0)
    a, w, shrink = a / scale, np.zeros(a.shape[1]), np.append(np.full(x.shape[1], 0.1), 0.0)
    weight = np.where(y, ((~y).sum() / y.sum()) ** balance, 1.0)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (weight * (p - y)) + shrink * w
        h = (a * (weight * p * (1 - p) + 1e-9)[:, None]).T @ a + 0.1 * np.eye(a.shape[1])
        d = np.linalg.solve(h, g)
        w -= np.clip(d, -2, 2)
        if abs(d).max() < 1e-8:
            break
    return w / scale


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 8000) -> Model:
    """The toxicity model from at most ``max_rows`` labelled rows (a bounded sample; the only thing the driver holds)."""
    return fit(*training_rows(docs, labels, "toxic", max_rows))


def op10_toxicity(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs, model).select("doc_id", held_out(), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
