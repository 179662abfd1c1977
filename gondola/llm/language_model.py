"""LM scoring (10): an interpolated modified Kneser-Ney model of any order, counted in Spark.

Tokens are the words of a text, then one end; start markers precede the first one. Words are 64-bit hashes, and
so are histories: the `order` - 1 tokens before a token. A history and a token are a pair.

* Counting. Executors reduce the pairs of some million tokens at a time to distinct ones and pack them
  by shard of the history; a shard's packs meet in one task, which sums them. A frequent history is thus one
  entry per pair and pack before any shuffle. How many different tokens precede a pair of the next lower order,
  its continuation count, is summed over shards by a DataFrame aggregation; these counts are the lower
  order's, down to single words.
* Model. Each shard is a file of sorted hash arrays in the shared checkpoint folder: pair hash and count;
  history, its total and how many of its pairs occur once, twice, more often; word, count, continuation
  count. Files are renamed into place when complete, so a task that is run again just writes them again. There
  is a shard for each `SHARD` bytes of text at least, so a task's shards stay the same size as the input grows.
* Scoring. Workers map the files into memory and look the sorted pairs of a run of texts up. Pages are
  shared by the workers of a machine and dropped under pressure; nothing of the model is broadcast but its
  discounts. Where the folder is no local mount, a worker keeps a bounded number of fetched files in memory.

P(w|v) = (c(vw) - D)/c(v.) + (D1 n1(v) + D2 n2(v) + D3 n3(v))/c(v.) * P(w|v'), v' being v without its first token; lower
orders are the same over continuation counts, and below single words is 1/(V+1) for each of V words and all
unknown ones together. Discounts come from each order's counts of counts.

Defined results: a null or blank text is one end token; without training tokens every P is 1/(V+1) = 1.
Repeated documents count as often as they occur.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F

from gondola.llm import stores, words as W
from gondola.llm.common import by_batch, cut, shared_folder

START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
#: Tokens whose pairs are reduced together before they are sent on.
PACK = 2_000_000
#: Bytes of text that a shard is made for.
SHARD = 64 << 20


def tokens(run: W.Words, order: int = 2) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(histories of `order` - 1 tokens down to one, token, text) of all tokens of a run, in order."""
    counts = np.diff(run.first) + 1
    last = np.cumsum(counts) - 1
    token = np.empty(int(counts.sum()), dtype=np.uint64)
    word = np.ones(len(token), dtype=bool)
    word[last] = False
    token[word], token[last] = run.hashes, END
    place = np.arange(len(token)) - np.repeat(last - counts + 1, counts)
    histories: list[np.ndarray] = []
    for back in range(1, order):
        before = np.full(len(token), START)
        inside = np.flatnonzero(place >= back)
        before[inside] = token[inside - back]
        histories.insert(0, pair_key(before, histories[0]) if histories else before)
    return histories, token, np.repeat(np.arange(run.texts), counts)


def pair_key(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return W.mix(before * np.uint64(0xD6E8FEB86659FD93) + token)


def shard_of(word: np.ndarray, shards: int) -> np.ndarray:
    return (word % np.uint64(shards)).astype(np.int64)


def _reduced(v: np.ndarray, w: np.ndarray, n: np.ndarray, *short: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct pairs, in the order of their keys, with summed counts, and the shorter histories of each."""
    key = pair_key(v, w)
    order = np.argsort(key)
    key = key[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, dtype=np.int64)
    at = order[new]
    return v[at], w[at], np.add.reduceat(n[order], new) if len(new) else n[:0], *[h[at] for h in short]


def _packed(v: np.ndarray, w: np.ndarray, n: np.ndarray, *short: np.ndarray, shards: int) -> Iterator[tuple[int, bytes, int]]:
    """(shard, its pairs, their bytes): each history once with its shorter ones and number of pairs, then tokens, then counts."""
    shard = shard_of(v, shards)
    order = np.lexsort((v, shard))
    v, w, n, shard = v[order], w[order], n[order].astype(np.uint32), shard[order]
    short = [h[order] for h in short]
    for s in np.unique(shard):
        low, high = np.searchsorted(shard, [s, s + 1])
        first, at, times = np.unique(v[low:high], return_index=True, return_counts=True)
        head = np.array([len(first), high - low], dtype=np.int64)
        body = [head, first, *[h[low:high][at] for h in short], times.astype(np.uint32), w[low:high], n[low:high]]
        yield int(s), pa.compress(b"".join(x.tobytes() for x in body), codec="lz4_raw", asbytes=True), sum(x.nbytes for x in body)


def _unpacked(pack: bytes, size: int, shorter: int) -> tuple[np.ndarray, ...]:
    raw = pa.decompress(pack, size, codec="lz4_raw", asbytes=True)
    words, pairs = np.frombuffer(raw, np.int64, 2).tolist()
    at = 16
    first, *short = (np.frombuffer(raw, np.uint64, words, at + 8 * words * k) for k in range(1 + shorter))
    at += 8 * words * (1 + shorter)
    times = np.frombuffer(raw, np.uint32, words, at)
    w = np.frombuffer(raw, np.uint64, pairs, at := at + 4 * words)
    n = np.frombuffer(raw, np.uint32, pairs, at + 8 * pairs).astype(np.int64)
    return np.repeat(first, times), w, n, *[np.repeat(h, times) for h in short]


def _pair_packs(text: str, shards: int, order: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            w, v, *short = (np.concatenate(x) for x in zip(*kept))
            packs = list(_packed(*_reduced(v, w, np.ones(len(v), dtype=np.int64), *short), shards=shards))
            kept.clear()
            kinds = (pa.int32(), pa.binary(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*packs), kinds)], ["shard", "pack", "size"])

        for batch in batches:
            for run in W.runs(batch.column(text)):
                histories, token, _ = tokens(run, order)
                kept.append((token, *histories))
                if sum(len(x[0]) for x in kept) >= PACK:
                    yield flush()
        if kept:
            yield flush()

    return work


#: What a shard tells. kind 0: a word, how many histories it follows there (of one token, else 0) and its count (of the
#: highest order, else 0); 1 to 4: how many pairs occur that often; 5: a pair of the next lower order (`history`, `word`) with how
#: many of the shard's histories precede it, and its own shorter histories.
ROWS = "kind int, word bigint, a bigint, b bigint, history bigint, short array<bigint>"


def _told(folder: str, s: int, level: int, top: bool, v: np.ndarray, w: np.ndarray, n: np.ndarray, *short: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Writes a shard's distinct pairs, sorted by their keys; gives its ROWS."""
    stores.write(folder, f"pairs{level}-{s}", {"key": pair_key(v, w), "count": np.minimum(n, 2**32 - 1).astype(np.uint32)})
    order = np.argsort(v)
    word, start = np.unique(v[order], return_index=True)
    total = lambda x: np.add.reduceat(x[order], start)
    of = [total((n == k).astype(np.int64)).astype(np.uint32) for k in (1, 2)] + [total((n > 2).astype(np.int64)).astype(np.uint32)]
    stores.write(folder, f"contexts{level}-{s}", dict(zip(("key", "total", "n1", "n2", "n3"), (word, total(n).astype(np.uint64), *of))))
    often = [int((n == k).sum()) for k in (1, 2, 3, 4)]
    yield _rows(np.arange(1, 5), np.zeros(4, np.uint64), np.array(often), np.zeros(4, np.int64))
    if top or level == 2:
        order = np.argsort(w)
        word, start, before = np.unique(w[order], return_index=True, return_counts=True)
        count = np.add.reduceat(n[order], start) if top else np.zeros(len(word), np.int64)
        yield _rows(np.zeros(len(word)), word, before if level == 2 else np.zeros(len(word)), count)
    if level > 2:
        low_v, low_w, before, *rest = _reduced(short[0], w, np.ones(len(w), dtype=np.int64), *short[1:])
        yield _rows(np.full(len(low_w), 5), low_w, before, np.zeros(len(low_w)), low_v, rest)


def _rows(kind, word, a, b, history=None, short=()) -> pa.RecordBatch:
    size = len(kind)
    history = np.zeros(size, np.uint64) if history is None else history
    flat = np.column_stack(short).ravel() if short else np.empty(0, np.uint64)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(size + 1, dtype=np.int32) * len(short)), pa.array(flat.view(np.int64)))
    arrays = [pa.array(kind.astype(np.int32)), pa.array(word.view(np.int64)), pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)), pa.array(history.view(np.int64)), lists]
    return pa.RecordBatch.from_arrays(arrays, ["kind", "word", "a", "b", "history", "short"])


def _write_packs(folder: str, order: int):
    """Sums the packs of each shard of a partition and writes it; gives ROWS."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packs: dict[int, list[tuple[bytes, int]]] = {}
        for batch in batches:
            for s, pack, size in zip(*(batch.column(c).to_pylist() for c in ("shard", "pack", "size"))):
                packs.setdefault(s, []).append((pack, size))
        for s in sorted(packs):
            whole = (np.concatenate(x) for x in zip(*(_unpacked(*p, order - 2) for p in packs.pop(s))))
            yield from _told(folder, s, order, True, *_reduced(*whole))

    return work


def _write_lower(folder: str, shards: int, level: int):
    """Writes the shards of lower pairs, each of which is summed already; gives ROWS."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[batch.column(c) for c in ("history", "word", "a", "short")] for batch in batches if batch.num_rows]
        if not parts:
            return
        v, w, n = (np.concatenate([p[k].to_numpy() for p in parts]) for k in range(3))
        short = np.concatenate([p[3].flatten().to_numpy() for p in parts]).reshape(len(v), level - 2)
        v, w, short = v.view(np.uint64), w.view(np.uint64), short.astype(np.int64).view(np.uint64)
        order = np.argsort(pair_key(v, w))
        v, w, n, short = v[order], w[order], n[order], short[order]
        shard = shard_of(v, shards)
        for s in np.unique(shard).tolist():
            own = shard == s
            yield from _told(folder, s, level, False, v[own], w[own], n[own], *short[own].T)

    return work


def _write_words(folder: str, shards: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[batch.column(c).to_numpy() for c in ("word", "b", "a")] for batch in batches if batch.num_rows]
        if parts:
            word, count, before = (np.concatenate(x) for x in zip(*parts))
            word = word.view(np.uint64)
            order = np.lexsort((word, shard_of(word, shards)))
            word, count, before = word[order], count[order], before[order]
            shard = shard_of(word, shards)
            for s in np.unique(shard):
                low, high = np.searchsorted(shard, [s, s + 1])
                stores.write(folder, f"words-{s}", dict(zip(("key", "count", "before"), (word[low:high], count[low:high].astype(np.uint64), before[low:high].astype(np.uint32)))))
                yield pa.RecordBatch.from_arrays([pa.array([int(s)], pa.int32())], ["shard"])

    return work


def discounts(often: list[int]) -> tuple[float, float, float]:
    """D1, D2 and D3+ from how many grams occur once to four times; 0.5, 1, 1.5 where these say nothing."""
    n1, n2, n3, n4 = often
    if min(often) == 0:
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(d if 0 < d < k else k / 2 for k, d in enumerate(found, 1))


@dataclass
class Model:
    """Where the arrays are, and the few numbers that hold for all of them."""

    folder: str
    shards: int
    order: int
    pairs: dict[int, frozenset[int]]  # by level, from `order` down to 2: shards that have files
    words: frozenset[int]
    tokens: int
    vocabulary: int
    types: int  # distinct pairs of the lowest level
    pair_discounts: dict[int, tuple[float, float, float]]
    word_discounts: tuple[float, float, float]
    word_often: tuple[int, int, int]  # words with a continuation count of one, two, more

    def _find(self, kind: str, columns: tuple[str, ...], shard_key: np.ndarray, key: np.ndarray, have: frozenset[int]) -> list[np.ndarray]:
        """The columns of each key's entry, 0 where there is none."""
        shard = shard_of(shard_key, self.shards)
        order = np.lexsort((key, shard))
        bounds = np.searchsorted(shard[order], np.arange(self.shards + 1))
        out = [np.zeros(len(key)) for _ in columns]
        for s in np.flatnonzero(np.diff(bounds)).tolist():
            if s not in have:
                continue
            own = order[bounds[s] : bounds[s + 1]]
            found = stores.read(self.folder, f"{kind}-{s}")
            at = np.searchsorted(found["key"], key[own])
            at[at == len(found["key"])] = 0
            same = found["key"][at] == key[own]
            for values, column in zip(out, columns):
                values[own[same]] = found[column][at[same]]
        return out

    def score(self, run: W.Words) -> list[np.ndarray]:
        """By text: tokens, known tokens, base score and log10 probability."""
        histories, w, owner = tokens(run, self.order)
        _, first, back = np.unique(pair_key(histories[0], w), return_index=True, return_inverse=True)
        word, at_w = np.unique(w[first], return_inverse=True)
        seen, before = self._find("words", ("count", "before"), word, word, self.words)
        d = np.array([0.0, *self.word_discounts])
        types, uniform = max(self.types, 1), 1 / (self.vocabulary + 1)
        spare = sum(x * k for x, k in zip(self.word_discounts, self.word_often)) / types if self.types else 1.0
        p = ((before - d[np.minimum(before, 3).astype(int)]) / types + spare * uniform)[at_w]
        for level in range(2, self.order + 1):
            v = histories[self.order - level][first]
            history, at_v = np.unique(v, return_inverse=True)
            total, n1, n2, n3 = self._find(f"contexts{level}", ("total", "n1", "n2", "n3"), history, history, self.pairs[level])
            (count,) = self._find(f"pairs{level}", ("count",), v, pair_key(v, w[first]), self.pairs[level])
            d1, d2, d3 = self.pair_discounts[level]
            d = np.array([0.0, d1, d2, d3])
            whole = np.maximum(total, 1)
            back_off = np.where(total > 0, (d1 * n1 + d2 * n2 + d3 * n3) / whole, 1.0)
            p = (count - d[np.minimum(count, 3).astype(int)]) / whole[at_v] + back_off[at_v] * p
        base = np.log10((seen[at_w] + 1) / (self.tokens + self.vocabulary + 1))
        add = lambda x: np.bincount(owner, x[back], run.texts)
        return [np.bincount(owner, minlength=run.texts), add((seen[at_w] > 0).astype(float)).astype(np.int64), add(base), add(np.log10(p))]


def _shard_column(name: str, shards: int) -> Column:
    """The unsigned modulo of a signed hash column, as shard_of takes it."""
    return F.pmod(F.shiftrightunsigned(name, 32) % shards * (2**32 % shards) + F.col(name).bitwiseAND(2**32 - 1), F.lit(shards))


def train(docs: DataFrame, *, text: str = "text", shards: int | None = None, order: int = 2) -> Model:
    """Counts the documents. `shards` is by default one for each SHARD bytes of text, and at least the
    session's shuffle partitions. The model's files take some 25 bytes a distinct pair and order."""
    if order < 2:
        raise ValueError(f"an order of {order}; at least 2")
    spark = docs.sparkSession
    if shards is None:
        size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD))
    folder = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    packs = docs.select(text).mapInArrow(_pair_packs(text, shards, order), "shard int, pack binary, size bigint")
    rows = packs.repartition(shards, "shard").mapInArrow(_write_packs(folder, order), ROWS)
    summed = lambda frame, level: cut(frame.where("kind < 5").groupBy(F.lit(level).alias("level"), "kind", "word").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    kept = []
    for level in range(order, 1, -1):
        if level > 2:
            rows = cut(rows)  # read again for the next level
        kept.append(summed(rows, level))
        if level > 2:
            lower = rows.where("kind = 5").groupBy("history", "word").agg(F.sum("a").alias("a"), F.any_value("short").alias("short"))
            lower = lower.withColumn("shard", _shard_column("history", shards)).repartition(shards, "shard").drop("shard")
            rows = lower.select("history", "word", "a", "short").mapInArrow(_write_lower(folder, shards, level - 1), ROWS)
    stats = kept[0]
    for more in kept[1:]:
        stats = stats.unionByName(more)
    words = stats.where("kind = 0").groupBy("word").agg(F.sum("a").alias("a"), F.sum("b").alias("b")) if order > 2 else stats.where("kind = 0")
    tall = lambda c, k: F.sum(F.when(F.col(c) == k, 1).otherwise(0))
    n, v, types, *often = words.agg(F.sum("b"), F.count("*"), F.sum("a"), *[tall("a", k) for k in (1, 2, 3, 4)]).first()
    pair_often = {(r.level, r.kind): r.a for r in stats.where("kind > 0").collect()}
    sharded = words.withColumn("shard", _shard_column("word", shards)).repartition(shards, "shard").select("word", "a", "b")
    written = sharded.mapInArrow(_write_words(folder, shards), "shard int").collect()
    often = [k or 0 for k in often]
    levels = range(2, order + 1)
    return Model(
        folder, shards, order, {k: frozenset(_listed(folder, f"contexts{k}-")) for k in levels}, frozenset(r.shard for r in written), n or 0, v, types or 0,
        {k: discounts([pair_often.get((k, i), 0) for i in (1, 2, 3, 4)]) for k in levels}, discounts(often), (often[0], often[1], v - often[0] - often[1]),
    )


def _listed(folder: str, start: str) -> list[int]:
    system, path = stores.place(folder)
    names = [x.base_name for x in system.get_file_info(fs.FileSelector(path, allow_not_found=True))]
    return [int(x.removeprefix(start)) for x in names if x.startswith(start)]


def score(docs: DataFrame, model: Model, *, text: str = "text", added: str = "lm") -> DataFrame:
    """The documents with a struct column `added`: n_tokens, n_known, base_score, score."""

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        parts = [model.score(run) for run in W.runs(batch.column(text))]
        return [pa.array(np.concatenate(x)) for x in zip(*parts)]

    return by_batch(docs, added, "n_tokens bigint, n_known bigint, base_score double, score double", work)
