"""Quality classifier (5): histogram gradient-boosted trees over statistics of whole documents.

Executors turn texts into a row of statistics each (`statistics`), straight from the Arrow buffers. The
model is fitted on the driver from the statistics of at most `SAMPLE` labelled documents; fitting never
sees a text. Trees are complete and flattened: level by level, a node's feature and threshold, then the
leaves, so a batch descends all trees with a few numpy operations. The broadcast model is some 50 kB,
whatever the input.

Defined results: a null, empty or blank text has all-zero statistics and the score those get; without
usable labels every score is 0.5, with one class only it is near that class. Repeated rows score alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gondola.llm import words as W
from gondola.llm.common import by_batch, free, labelled_sample

#: Labelled documents that a model is fitted on, at most.
SAMPLE = 20_000
KEEP = 0.7

NEWLINE = np.zeros(256, dtype=bool)
NEWLINE[0x0A] = True

#: Classes of bytes whose shares of a text are statistics; the rest has class 0.
CLASSES = ("A-Z", "0-9", ".,;:?", "!", "|", "#*$%&<>@^~=", "\"'()[]{}-_/\\`+", " \t\n\v\f\r")
CLASS = np.zeros(256, dtype=np.int64)
for _k, _chars in enumerate(CLASSES, 1):
    _chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZ" if _chars == "A-Z" else "0123456789" if _chars == "0-9" else _chars
    CLASS[[ord(c) for c in _chars]] = _k
CLASS[0x80:] = len(CLASSES) + 1
KINDS = len(CLASSES) + 2


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.divide(part, whole, out=np.zeros(len(whole)), where=whole > 0)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values of each text."""
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.float64)])[first])


def _repeats(hashes: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By text: distinct values, values in all, and how often the commonest one occurs."""
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    start = np.flatnonzero(new)
    most = np.zeros(texts)
    np.maximum.at(most, owner[start], np.diff(np.append(start, len(hashes))))
    return np.bincount(owner[start], minlength=texts), np.bincount(owner, minlength=texts), most


def _run_statistics(run: W.Words, lines: W.Words) -> np.ndarray:
    texts, size = run.texts, np.diff(run.offsets).astype(np.float64)
    count = np.diff(run.first).astype(np.float64)
    owner = np.repeat(np.arange(texts) * KINDS, np.diff(run.offsets))
    kinds = np.bincount(owner + CLASS[run.data], minlength=texts * KINDS).reshape(texts, KINDS)
    length = (run.ends - run.starts).astype(np.float64)
    longest = np.zeros(texts)
    np.maximum.at(longest, run.owner, length)
    distinct, _, most = _repeats(run.hashes, run.owner, texts)
    pair, position = W.windows(run, 2)
    pairs, all_pairs, _ = _repeats(pair, run.owner[position], texts)
    line, all_lines, most_line = _repeats(lines.hashes, lines.owner, texts)
    ends = CLASS[run.data[run.ends - 1]] if len(run.ends) else np.empty(0, dtype=np.int64)
    odd = _sums((ends >= 4) & (ends <= 7), run.first)
    once = np.zeros(len(run.hashes))
    once[1:] = run.hashes[1:] == run.hashes[:-1]
    once[run.first[:-1][count > 0]] = 0
    return np.column_stack([
        np.log1p(count), _share(_sums(length, run.first), count), np.minimum(longest, 1000.0),
        np.column_stack([_share(kinds[:, k], size) for k in range(1, KINDS)]),
        _share(distinct, count), _share(most, count), _share(pairs, all_pairs), _share(_sums(once, run.first), count),
        _share(odd, count), np.log1p(all_lines), _share(line, all_lines), _share(most_line, all_lines), _share(count, all_lines),
    ])


def statistics(column: pa.Array) -> np.ndarray:
    """A row of statistics for each text of the column."""
    pairs = zip(W.runs(column, lower=False), W.runs(column, NEWLINE, lower=False))
    parts = [_run_statistics(run, lines) for run, lines in pairs]
    return np.concatenate(parts) if parts else np.empty((0, 0))


@dataclass
class Trees:
    """`feature` and `threshold` by tree and inner node (in level order), `leaf` by tree and leaf."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        inner = self.feature.shape[1]
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range((inner + 1).bit_length() - 1):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, ridge: float = 1.0, least: float = 2.0) -> Trees:
    """Boosts complete trees on the logistic loss; splits come from histograms of binned statistics.

    `least` is the smallest sum of second derivatives on either side of a split.
    """
    inner = 2**depth - 1
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Trees(float(np.log(share / (1 - share))), np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    if not len(y) or y.min() == y.max():
        return model
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
    width = max(len(e) for e in edges) + 1
    margin = np.full(len(y), model.start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, curve = p - y, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            low, count = 2**level - 1, 2**level
            place = node - low
            best = np.full(count, 1e-9)
            for f in range(x.shape[1]):
                code = place * width + binned[:, f]
                g = np.bincount(code, slope, count * width).reshape(count, width)
                h = np.bincount(code, curve, count * width).reshape(count, width)
                gl, hl = np.cumsum(g, 1)[:, :-1], np.cumsum(h, 1)[:, :-1]
                ga, ha = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                gain = gl**2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga**2 / (ha + ridge)
                gain[(hl < least) | (ha - hl < least)] = 0
                gain[:, len(edges[f]) :] = 0
                at = gain.argmax(1)
                value = gain[np.arange(count), at]
                for k in np.flatnonzero(value > best):
                    best[k] = value[k]
                    model.feature[t, low + k], model.threshold[t, low + k] = f, edges[f][at[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), model.feature[t, node]] > model.threshold[t, node])
        place = node - inner
        g, h = np.bincount(place, slope, inner + 1), np.bincount(place, curve, inner + 1)
        model.leaf[t] = -rate * g / (h + ridge)
        margin += model.leaf[t, place]
    return model


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", label: str = "quality", folds: int = 4, held: int = 2, sample: int = SAMPLE, **options) -> Trees:
    """Fits on the statistics of at most `sample` labelled documents outside the held-out fold."""
    rows = labelled_sample(docs, labels, key, label, folds, held, sample)

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        x = statistics(batch.column("text"))
        return [pa.array(list(x), pa.list_(pa.float64()))]

    found = by_batch(rows, "_x", "x array<double>", work).select("y", "_x.x").toArrow()
    y = found["y"].to_numpy().astype(np.float64)
    x = np.array(found["x"].to_pylist()).reshape(len(y), -1 if len(y) else 1)
    order = np.lexsort(np.column_stack([x, y]).T)  # sums of a histogram depend on it
    return fit(x[order], y[order], **options)


def score(docs: DataFrame, model: Trees, *, text: str = "text", added: str = "quality") -> DataFrame:
    """The documents with a struct column `added` that holds the score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return by_batch(docs, added, "score double", lambda batch: [pa.array(sent.value.score(statistics(batch.column(text))))])


def keep(docs: DataFrame, model: Trees, *, text: str = "text", least: float = KEEP) -> DataFrame:
    """The documents' own columns, of those whose score is at least `least`."""
    own = free(docs, "_quality")
    return score(docs, model, text=text, added=own).where(F.col(f"{own}.score") >= least).drop(own)
