"""Toxicity (6): FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct words, word pairs, and pairs with one or two words between, of its
whole lower-cased text, hashed into 2**`BITS` places; each counts 1 if present. The model is learned online
(one document a step, `epochs` times) on the driver from the features of at most `SAMPLE` labelled
documents: every weight has its own learning rate, and L1 keeps most weights at exactly 0. Only the
weights that are not 0 are broadcast; executors look all n-grams of whole texts up in them.

Defined results: a null, empty or wordless text has no features and the score of the bias; without usable
labels every score is 0.5. Repeated words count once, repeated rows score alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gondola.llm import words as W
from gondola.llm.common import by_batch, labelled_sample

#: Labelled documents that a model is fitted on, at most.
SAMPLE = 16_000
BITS = 20
TOXIC = 0.5


def _grams(run: W.Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(place, text) of each kind of n-gram of the run."""
    h, owner = run.hashes, run.owner
    out = [(h, owner)]
    for apart in (1, 2, 3):
        mixed = W.mix(h[:-apart] * np.uint64(0xD6E8FEB86659FD93) + h[apart:] + np.uint64(apart)) if len(h) > apart else h[:0]
        same = owner[:-apart] == owner[apart:] if len(h) > apart else np.empty(0, dtype=bool)
        out.append((mixed[same], owner[: len(mixed)][same]))
    return [((g >> np.uint64(64 - BITS)).astype(np.int64), o) for g, o in out]


def features(column: pa.Array) -> list[np.ndarray]:
    """The distinct places of each text."""
    out: list[np.ndarray] = []
    for run in W.runs(column, W.NOT_ALPHANUMERIC):
        grams = _grams(run)
        code = np.unique(np.concatenate([(o << BITS) | p for p, o in grams]))
        out.extend(np.split(code & ((1 << BITS) - 1), np.searchsorted(code, np.arange(1, run.texts) << BITS)))
    return out


@dataclass
class Weights:
    """The bias and the weights that are not 0, by place."""

    bias: float
    places: np.ndarray
    values: np.ndarray

    def score(self, column: pa.Array) -> np.ndarray:
        dense = self._dense()
        parts = [self._run(run, dense) for run in W.runs(column, W.NOT_ALPHANUMERIC)]
        return np.concatenate(parts) if parts else np.empty(0)

    def _dense(self) -> np.ndarray:
        if "_table" not in self.__dict__:
            self._table = np.zeros(1 << BITS)
            self._table[self.places] = self.values
        return self._table

    def _run(self, run: W.Words, dense: np.ndarray) -> np.ndarray:
        hit = []
        for place, owner in _grams(run):
            kept = np.flatnonzero(dense[place])
            hit.append((owner[kept] << BITS) | place[kept])
        code = np.unique(np.concatenate(hit))
        total = np.bincount(code >> BITS, dense[code & ((1 << BITS) - 1)], run.texts) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(
    rows: list[np.ndarray], y: np.ndarray, epochs: int = 4, alpha: float = 2.0, beta: float = 1.0,
    l1: float = 10.0, l2: float = 1.0, seed: int = 7,
) -> Weights:
    """Follows the proximally regularised leader, in an order drawn anew for each epoch."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    bias = 1 << BITS

    def weights(at):
        w = -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        w[np.abs(z[at]) <= l1] = 0
        if at[-1] == bias:  # free of penalties
            w[-1] = -z[bias] / ((beta + np.sqrt(n[bias])) / alpha)
        return w

    random = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in random.permutation(len(rows)):
            at = np.append(rows[k], bias)
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - y[k]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(bias + 1))
    places = np.flatnonzero(w[:-1])
    return Weights(float(w[-1]), places, w[places])


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", label: str = "toxic", folds: int = 5, held: int = 0, sample: int = SAMPLE, **options) -> Weights:
    """Fits on the features of at most `sample` labelled documents outside the held-out fold."""
    rows = labelled_sample(docs, labels, key, label, folds, held, sample)

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        kept = [f.astype(np.int32).tobytes() for f in features(batch.column("text"))]
        return [pa.array(kept, pa.binary())]

    found = by_batch(rows, "_x", "x binary", work).select("y", "_x.x").toArrow().sort_by([("x", "ascending"), ("y", "ascending")])
    kept = [np.frombuffer(x.as_py(), dtype=np.int32) for x in found["x"]]
    return fit(kept, found["y"].to_numpy().astype(np.float64), **options)


def score(docs: DataFrame, model: Weights, *, text: str = "text", added: str = "toxicity") -> DataFrame:
    """The documents with a struct column `added` that holds the score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return by_batch(docs, added, "score double", lambda batch: [pa.array(sent.value.score(batch.column(text)))])
