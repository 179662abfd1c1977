"""Benchmark decontamination (4).

The windows of all benchmark items are normalised, hashed and broadcast as a sorted array, once its size
is known; executors scan the words of whole texts, look each window's hash up and verify each hit word
by word. An item with fewer words than a window is one window of its own length.

* `scan` adds a struct column: n_words, n_hit, items (ids, sorted as strings), spans (byte ranges of the
  UTF-8 text that hits cover, merged).
* `clean` drops contaminated documents or cuts the spans out of their texts.

Defined results: a null or blank text has no words and no hits, a null or wordless item has no windows,
a null item id is the string "null". Repeated documents are judged row by row, repeated items and ids
count once, empty tables give no hits. Other columns pass through untouched.

A benchmark of up to `BLOCK_BYTES` is one broadcast. A larger one is dealt into blocks by item, each of
which is broadcast and scanned in turn, so no machine ever holds more than a block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gondola.llm import words as W
from gondola.llm.common import by_batch, cut, free

WINDOW = 10
#: Bytes of benchmark text in a block at most; its arrays take some five times as much.
BLOCK_BYTES = 16 << 20
FIELDS = "n_words bigint, n_hit bigint, items array<string>, spans array<struct<start: bigint, stop: bigint>>"
_FILTER_BITS = 20
_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])


@dataclass
class Windows:
    """The windows of some items as arrays, in the order of their hashes: each is an item and a first word.

    The items' words are kept once, as bytes with their bounds; a window costs 16 bytes, however many
    words it has."""

    names: list[str]  # of the items
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    item: np.ndarray
    first: np.ndarray  # word
    width: np.ndarray  # of each item's windows
    widths: list[int]
    filter: np.ndarray

    @classmethod
    def of(cls, items: list[tuple[str, str]], window: int) -> Windows:
        parts, words, size = [], 0, 0
        width = np.zeros(len(items), dtype=np.int64)
        for run in W.runs(pa.array([text for _, text in items], pa.large_string()), W.NOT_ALPHANUMERIC):
            count = np.diff(run.first)
            width[run.at : run.at + run.texts] = np.minimum(count, window)
            hashes, place = W.windows(run, window)
            short = [(W.window_hashes(run.hashes[run.first[k] : run.first[k + 1]], int(count[k])), run.first[k : k + 1]) for k in np.flatnonzero((count > 0) & (count < window))]
            hashes, place = (np.concatenate(x) for x in zip((hashes, place), *short))
            parts.append((run.data, run.starts + size, run.ends + size, hashes, run.owner[place] + run.at, place + words))
            words, size = words + len(run.starts), size + len(run.data)
        empty = [np.empty(0, t) for t in (np.uint8, np.int64, np.int64, np.uint64, np.int64, np.int64)]
        data, starts, ends, hashes, item, first = (np.concatenate(x) for x in zip(empty, *parts))
        order = np.argsort(hashes, kind="stable")
        narrow = lambda x: x.astype(np.int32 if size < 2**31 else np.int64)
        known = np.zeros(1 << _FILTER_BITS, dtype=bool)
        known[hashes >> np.uint64(64 - _FILTER_BITS)] = True
        widths = sorted(set(width[width > 0].tolist()))
        return cls([name for name, _ in items], data, narrow(starts), narrow(ends), hashes[order], narrow(item[order]), narrow(first[order]), width, widths, known)

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in vars(self).values() if isinstance(x, np.ndarray))

    def _text(self, first: int, width: int) -> bytes:
        bounds = zip(self.starts[first : first + width].tolist(), self.ends[first : first + width].tolist())
        return b" ".join([self.data[a:b].tobytes() for a, b in bounds])

    def hits(self, run: W.Words, width: int) -> list[tuple[int, list[str]]]:
        """(first word, items) of each verified window of this width."""
        hashes, position = W.windows(run, width)
        maybe = np.flatnonzero(self.filter[hashes >> np.uint64(64 - _FILTER_BITS)])
        if not len(maybe):
            return []
        low = np.searchsorted(self.hashes, hashes[maybe], side="left")
        high = np.searchsorted(self.hashes, hashes[maybe], side="right")
        out = []
        for k in np.flatnonzero(low < high):
            p = int(position[maybe[k]])
            text = b" ".join([run.word(q) for q in range(p, p + width)])
            same = [j for j in range(low[k], high[k]) if self.width[self.item[j]] == width and self._text(int(self.first[j]), width) == text]
            if same:
                out.append((p, [self.names[self.item[j]] for j in same]))
        return out


def _column(batch: pa.RecordBatch, text: str, windows: Windows) -> list[pa.Array]:
    n_words, n_hit, items, spans = [], [], [], []
    for run in W.runs(batch.column(text), W.NOT_ALPHANUMERIC):
        hit = np.zeros(len(run.starts), dtype=bool)
        named: dict[int, set[str]] = {}
        for width in windows.widths:
            for p, ids in windows.hits(run, width):
                hit[p : p + width] = True
                named.setdefault(int(run.owner[p]), set()).update(ids)
        sums = np.concatenate([[0], np.cumsum(hit)])
        n_words.append(np.diff(run.first))
        n_hit.append(np.diff(sums[run.first]))
        for k in range(run.texts):
            items.append(sorted(named.get(k, ())))
            spans.append(_spans(run, hit, k, run.offsets[k]) if k in named else [])
    whole = lambda parts: pa.array(np.concatenate(parts).astype(np.int64) if parts else [], pa.int64())
    return [whole(n_words), whole(n_hit), pa.array(items, pa.list_(pa.string())), pa.array(spans, pa.list_(_SPAN))]


def _spans(run: W.Words, hit: np.ndarray, k: int, base: int) -> list[dict[str, int]]:
    """Ranges of bytes from the first to the last word of each row of hit words."""
    low, high = run.first[k], run.first[k + 1]
    edge = np.diff(np.concatenate([[0], hit[low:high].astype(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1) + low, np.flatnonzero(edge == -1) - 1 + low
    return [{"start": int(run.starts[a] - base), "stop": int(run.ends[b] - base)} for a, b in zip(first, last)]


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int):
    """Lists of (item id, text), each of about `block_bytes` at most (one larger item is its own)."""
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"), F.col(text).alias("text"))
    items = items.where(F.col("text").isNotNull()).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // block_bytes) or 1
    for k in range(count):
        part = items if count == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k)
        yield count, [(r.item, r.text) for r in part.collect()]


def scan(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text",
    added: str = "hits", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents with a struct column `added` of what they share with the benchmark."""
    context, parts = docs.sparkSession.sparkContext, []
    for count, items in _blocks(benchmark, item, item_text, block_bytes):
        sent = context.broadcast(Windows.of(items, window))
        work = lambda batch, sent=sent: _column(batch, text, sent.value)
        if count == 1:
            return by_batch(docs, added, FIELDS, work)
        found = by_batch(docs.select(text), "_b", FIELDS, work).where("_b.n_hit > 0")
        parts.append(cut(found.select(F.xxhash64(text).alias("_h"), F.md5(text).alias("_m"), "_b.*").distinct()))
    return _merged(docs, parts, text, added)


def _merged(docs: DataFrame, parts: list[DataFrame], text: str, added: str) -> DataFrame:
    """The hits of several blocks put together by text; hit words are counted anew over merged spans."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    union = rows.groupBy("_h", "_m").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("_i"),
        F.flatten(F.collect_list("spans")).alias("_s"),
    )
    columns = docs.drop(added).columns
    keyed = docs.drop(added).withColumns({"_h": F.xxhash64(text), "_m": F.md5(text)})
    joined = keyed.join(union, ["_h", "_m"], "left").select(*columns, "_i", "_s")

    def count(batch: pa.RecordBatch) -> list[pa.Array]:
        n_words, n_hit, spans = [], [], []
        known = batch.column("_s").to_pylist()
        for run in W.runs(batch.column(text), W.NOT_ALPHANUMERIC):
            n_words.append(np.diff(run.first))
            hit = np.zeros(len(run.starts), dtype=bool)
            for k in range(run.texts):
                low, high, base = run.first[k], run.first[k + 1], run.offsets[k]
                for s in known[run.at + k] or ():
                    a, b = np.searchsorted(run.starts[low:high], [s["start"] + base, s["stop"] + base])
                    hit[low + a : low + b] = True
                n_hit.append(int(hit[low:high].sum()))
                spans.append(_spans(run, hit, k, base))
        return [pa.array(np.concatenate(n_words).astype(np.int64)), pa.array(n_hit, pa.int64()), pa.array(spans, pa.list_(_SPAN))]

    counted = by_batch(joined, "_n", "n_words bigint, n_hit bigint, spans array<struct<start: bigint, stop: bigint>>", count)
    items = F.coalesce("_i", F.array().cast("array<string>"))
    return counted.select(*columns, F.struct("_n.n_words", "_n.n_hit", items.alias("items"), "_n.spans").alias(added))


def clean(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", remove: str = "documents", **options) -> DataFrame:
    """The documents' own columns without contamination: `remove` is "documents" or "spans"."""
    own = free(docs, "_hits")
    found = scan(docs, benchmark, text=text, added=own, **options)
    if remove == "documents":
        return found.where(F.col(f"{own}.n_hit") == 0).drop(own)
    if remove != "spans":
        raise ValueError(remove)
    raw = F.encode(F.col(text), "utf-8")
    kept = F.aggregate(
        F.col(f"{own}.spans"),
        F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(b"").alias("done")),
        lambda a, s: F.struct(s.stop.alias("at"), F.concat(a.done, F.substring(raw, (a.at + 1).cast("int"), (s.start - a.at).cast("int"))).alias("done")),
        lambda a: F.decode(F.concat(a.done, F.substring(raw, (a.at + 1).cast("int"), F.octet_length(raw))), "utf-8"),
    )
    changed = F.when(F.size(f"{own}.spans") > 0, kept).otherwise(F.col(text))
    return found.withColumn(text, changed).drop(own)
