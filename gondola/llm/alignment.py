"""Cross-tokenizer alignment (12): which tokens of two vocabularies cover the same bytes, and how usual that is.

A text with a blank in front is cut into tokens by a byte-level vocabulary (A) and by a sentencepiece vocabulary
(B). Two tokens are linked if their byte ranges overlap. Between two neighbouring places where a token of
either side ends lies exactly one link, so a pass over the ends gives them all. A pair of ids counts once for
each document that holds it linked.

1. The first pass cuts and links the texts. Each task sums its pairs' documents, up to `MERGE` pairs at a time.
2. The distinct pairs are dealt by hash into shards of some `SHARD` pairs. A task builds a shard's
   minimal perfect hash and writes it with its keys to the shared folder.
3. Each task turns its sums into one dense vector a shard, indexed by the hash; keys are verified. Vectors of a
   shard are added up in a tree: first in `BRANCHES` branches, then those.
4. The second pass cuts and links again and looks the counts up by the hash, keys verified again. Workers map
   the shards' files; only the largest count of each A id is sent to them, a number for each id.

A pair that every document holds is one row per task of the first pass. No step holds all pairs at once.

The A ids come from the rank form of the vocabulary, which gives the same ids where merges are listed in the
order of their ids (checked when it is loaded). On neither side does a token reach from a word into the white
space after it (A's pattern does not; of B's pieces it is looked up, and the few characters for which it does not
hold, like a carriage return, hold words together), nor from a letter into most punctuation. So a text is linked
word by word, with the white space before it, and workers remember the links of words: up to `CACHE` characters of them, then they start anew.

Defined results: texts that are null, empty, or not given back byte for byte by both sides have no tokens, so
zeros and an empty digest. Repeated rows count as documents each. Empty tables give no rows. Special
tokens' strings are plain text. A column that is called like `added` is replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from gondola.llm import perfect_hash, stores, words as W
from gondola.llm.byte_bpe import PATTERN
from gondola.llm.common import by_batch, cut, shared_folder, texts

#: Characters that are linked together; pairs a task sums before it hands them on.
RUN, MERGE = 1 << 20, 2_000_000
SHARD, LEAST_SHARDS, SLOTS, BRANCHES = 1 << 15, 256, 1 << 16, 16
CACHE = 6_000_000
BLANK = "▁"
#: Latin letters, and punctuation before which a word of such letters is linked on its own if no piece forbids it.
LETTERS, MARKS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", ",.;:!?)\""

DIGEST = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabularies:
    """What workers need of both vocabularies: A's token bytes and ids, and B's model file."""

    ranks: dict[bytes, int]
    model: bytes
    size_a: int
    size_b: int
    glue: str  # white space other than a blank that is part of longer pieces
    marks: str  # punctuation that no piece has after a letter


def load(byte_level: str, pieces: str) -> Vocabularies:
    """Vocabularies from a byte-level BPE file (JSON) and a sentencepiece BPE file; at most 2**20 ids each."""
    import sentencepiece

    with open(byte_level, encoding="utf-8") as file:
        told = json.load(file)
    model, splitter = told["model"], told.get("pre_tokenizer") or {}
    if model["type"] != "BPE" or told.get("normalizer") or splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") or not splitter.get("use_regex"):
        raise ValueError(f"{byte_level} is not a plain byte-level BPE vocabulary")
    merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if any(x >= y for x, y in zip(merged, merged[1:])):
        raise ValueError(f"{byte_level} lists merges in another order than their ids")
    special = {t["content"] for t in told.get("added_tokens", ())}
    alphabet = byte_alphabet()
    ranks = {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    with open(pieces, "rb") as file:
        data = file.read()
    reader = sentencepiece.SentencePieceProcessor(model_proto=data)
    size = reader.get_piece_size()
    names = [reader.id_to_piece(i) for i in range(size)]
    if any(re.search(f"[^{BLANK}]{BLANK}", name) for name in names):
        raise ValueError(f"{pieces} has pieces that reach over a blank")
    glue = "".join(sorted({c for name in names if len(name) > 1 for c in name if c.isspace()}))
    marks = "".join(c for c in MARKS if not any(re.search(f"[{LETTERS}]{re.escape(c)}", name) for name in names))
    marks = marks if f"{BLANK}a" in names else ""
    size_a = max(model["vocab"].values()) + 1
    if max(size_a, size) > 1 << 20:
        raise ValueError(f"{max(size_a, size)} tokens are too many")
    return Vocabularies(ranks, data, size_a, size, glue, marks)


class Cutter:
    """Both tokenizers of a worker, and the words it has linked: by word, its tokens, groups and links."""

    def __init__(self, own: Vocabularies):
        import sentencepiece
        import tiktoken

        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=own.ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=own.model)
        self.a_length = np.zeros(own.size_a, dtype=np.int64)
        for token, i in own.ranks.items():
            self.a_length[i] = len(token)
        self.a_sizes = self.a_length.tolist()
        self.b_bytes = [self._piece(i) for i in range(own.size_b)]
        self.b_length = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.blank = self.b.piece_to_id(BLANK)
        self.size_b = own.size_b
        # a word with the white space before it, or the last white space; glue holds a word and the next together
        glue = f"[{re.escape(own.glue)}]" if own.glue else "(?!)"
        alone = rf"\s*[{LETTERS}]+(?=[ \n{re.escape(own.marks)}])|" if own.marks and "\n" not in own.glue else ""
        self.word = re.compile(rf"{alone}\s*\S+(?:{glue}\s*\S+)*(?:{glue}\s*\Z)?|\s+")
        self.marks = own.marks
        # an id and what follows it in the written groups: A's ids first
        self.names = [f"{i}{end}" for i in range(own.size_a) for end in ",|"] + [f"{i}{end}" for i in range(own.size_b) for end in ",;"]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.characters = 0
        self.written: list[str] = []  # each word's groups, with a semicolon after each
        self.counts = np.empty((0, 4), dtype=np.int64)  # A tokens, B tokens, groups, links
        self.pairs = np.empty(0, dtype=np.uint64)
        self.first = np.zeros(1, dtype=np.int64)  # where each word's pairs begin

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(BLANK, " ").encode()

    def cut(self, words: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """The A and B ids of each word; none on both sides if they don't give its bytes back."""
        a = [self.a.encode_ordinary(word) for word in words]
        # B puts a blank before each text; a mark gets a letter too, which it never joins
        b = self.b.encode([word[1:] if word[0] == " " else f"a{word}" if word[0] in self.marks else word for word in words], num_threads=1)
        for k, word in enumerate(words):
            if word == " ":
                b[k] = [self.blank]
            elif word[0] != " ":
                b[k] = b[k][1:]
            data = word.encode()
            if b"".join([self.b_bytes[i] for i in b[k]]) != data or sum([self.a_sizes[i] for i in a[k]]) != len(data):
                a[k], b[k] = [], []
        return a, b

    def learn(self, words: list[str]) -> None:
        """Links words that are not known yet."""
        found = link(self, *self.cut(words))
        counts = np.column_stack([
            np.diff(found.a_first), np.diff(found.b_first),
            np.bincount(found.owner[found.last], minlength=len(words)), np.bincount(found.owner, minlength=len(words)),
        ])
        pairs = (found.a[found.of_a] * self.size_b + found.b[found.of_b]).astype(np.uint64)
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.characters += sum(map(len, words))
        self.written += written(self, found)
        self.counts = np.concatenate([self.counts, counts])
        self.pairs = np.concatenate([self.pairs, pairs])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(counts[:, 3])])

    def look(self, run: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(word, text) of a run of texts, each with a blank in front; a text that a side doesn't give back has no words."""
        if self.characters > CACHE:
            self.forget()
        parts = [self.word.findall(" " + text) if text else [] for text in run]
        flat = [word for part in parts for word in part]
        try:
            words = np.fromiter(map(self.known.__getitem__, flat), dtype=np.int64, count=len(flat))
        except KeyError:
            self.learn(list(dict.fromkeys(word for word in flat if word not in self.known)))
            words = np.fromiter(map(self.known.__getitem__, flat), dtype=np.int64, count=len(flat))
        owner = np.repeat(np.arange(len(run)), [len(part) for part in parts])
        lost = np.zeros(len(run), dtype=bool)
        lost[owner[self.counts[words, 0] == 0]] = True
        return words[~lost[owner]], owner[~lost[owner]]


@dataclass
class Links:
    """The links of words: ids of both sides' tokens, and by link its tokens and word."""

    a: np.ndarray
    b: np.ndarray
    a_first: np.ndarray  # where each word's A tokens begin
    b_first: np.ndarray
    of_a: np.ndarray  # each link's A token
    of_b: np.ndarray
    owner: np.ndarray
    last: np.ndarray  # whether both sides' tokens end with the link: the end of a group


def link(cutter: Cutter, ids_a: list[list[int]], ids_b: list[list[int]]) -> Links:
    a, b = (np.fromiter((i for ids in side for i in ids), dtype=np.int64) for side in (ids_a, ids_b))
    first = [np.concatenate([[0], np.cumsum([len(ids) for ids in side])]) for side in (ids_a, ids_b)]
    end_a, end_b = np.cumsum(cutter.a_length[a]), np.cumsum(cutter.b_length[b])
    flags = np.zeros(int(end_a[-1]) + 1 if len(a) else 1, dtype=np.uint8)
    flags[end_a] = 1
    flags[end_b] |= 2
    flags = flags[np.flatnonzero(flags)]
    ends_a, ends_b = flags & 1, flags >> 1
    of_a, of_b = (np.cumsum(x, dtype=np.int64) - x for x in (ends_a, ends_b))
    owner = np.repeat(np.arange(len(ids_a)), np.diff(first[0]))[of_a] if len(a) else a
    return Links(a, b, *first, of_a, of_b, owner, flags == 3)


def written(cutter: Cutter, found: Links) -> list[str]:
    """Each word's groups as `a1,a2|b1;a3|b2,b3;`."""
    size = len(found.a) + len(found.b)
    group = np.cumsum(found.last) - found.last  # of each link
    group_a, group_b = np.empty(len(found.a), np.int64), np.empty(len(found.b), np.int64)
    group_a[found.of_a], group_b[found.of_b] = group, group
    groups = int(group[-1]) + 1 if len(group) else 0
    many_a, many_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    before_a, before_b = np.cumsum(many_a), np.cumsum(many_b)
    at_a = np.arange(len(found.a)) + (before_b - many_b)[group_a]
    at_b = np.arange(len(found.b)) + before_a[group_b]
    code = np.empty(size, dtype=np.int64)
    code[at_a], code[at_b] = found.a * 2, found.b * 2 + 2 * len(cutter.a_length)
    code[at_a[before_a - 1]] += 1  # the last A token of a group is followed by a bar, the last B token by a semicolon
    code[at_b[before_b - 1]] += 1
    code, first = code.tolist(), (found.a_first + found.b_first).tolist()
    names = cutter.names
    return ["".join([names[k] for k in code[low:high]]) for low, high in zip(first, first[1:])]


def pairs_by_text(cutter: Cutter, words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, pair, links) of each text's distinct pairs; a pair is a * size of B + b."""
    most = int(owner[-1]) + 1 if len(owner) else 1
    code, times = np.unique(words * most + owner, return_counts=True)  # each word of a text once
    words, owner = code // most, code % most
    many = cutter.counts[words, 3]
    at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(cutter.first[words], many)
    pair, text, times = cutter.pairs[at], np.repeat(owner, many), np.repeat(times, many)
    order = np.lexsort((pair, text))
    pair, text, times = pair[order], text[order], times[order]
    new = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (text[1:] != text[:-1])])) if len(pair) else np.empty(0, np.int64)
    return text[new], pair[new], np.add.reduceat(times, new) if len(new) else times


def digests(cutter: Cutter, words: np.ndarray, owner: np.ndarray, count: int) -> list[str]:
    """By text, the hash of its groups written as `a1,a2|b1;a3|b2,b3`."""
    bounds = np.searchsorted(owner, np.arange(count + 1)).tolist()
    words, known, out = words.tolist(), cutter.written, []
    for low, high in zip(bounds, bounds[1:]):
        text = "".join([known[k] for k in words[low:high]])
        out.append(hashlib.sha256(text[:-1].encode()).hexdigest() if text else "")
    return out


_cutters: dict[str, Cutter] = {}


def _on_worker(docs: DataFrame, own: Vocabularies):
    """Gives the worker's tokenizers; both passes find the same ones."""
    sent = docs.sparkSession.sparkContext.broadcast(own)
    name = hashlib.sha256(own.model + b"".join(own.ranks)).hexdigest()

    def cutter() -> Cutter:
        if name not in _cutters:
            _cutters.clear()
            _cutters[name] = Cutter(sent.value)
        return _cutters[name]

    return cutter


def _runs(column: pa.Array) -> Iterator[list[str]]:
    run, size = [], 0
    for text in texts(column):
        run.append(text)
        size += len(text)
        if size >= RUN:
            yield run
            run, size = [], 0
    if run:
        yield run


def _slot(pair: np.ndarray) -> np.ndarray:
    return (W.mix(pair) >> np.uint64(48)).astype(np.int64)


def _shard(slot, shards: int):
    """The shard of a slot, a number below `SLOTS`; also as a column."""
    return F.shiftright(slot * F.lit(shards), 16) if isinstance(slot, Column) else slot * shards >> 16


def _summed(pair: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pair, kind="stable")
    pair = pair[order]
    new = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.empty(0, np.int64)
    return pair[new], np.add.reduceat(count[order], new) if len(new) else count[:0]


def _pair_counts(cutter, text: str):
    """(slot, pair, k): in how many of a task's texts each pair is linked."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []

        def packed() -> pa.RecordBatch:
            pair, k = kept.pop()
            return pa.RecordBatch.from_arrays([pa.array(_slot(pair)), pa.array(pair.view(np.int64)), pa.array(k)], ["slot", "pair", "k"])

        waiting = 0
        for batch in batches:
            for run in _runs(batch.column(text)):
                pair, k = np.unique(pairs_by_text(cutter(), *cutter().look(run))[1], return_counts=True)
                kept.append((pair, k.astype(np.int64)))
                waiting += len(pair)
                if waiting > MERGE:
                    kept[:] = [_summed(*(np.concatenate(x) for x in zip(*kept)))]
                    if (waiting := len(kept[0][0])) > MERGE // 2:
                        yield packed()
                        waiting = 0
        if kept:
            kept[:] = [_summed(*(np.concatenate(x) for x in zip(*kept)))]
            yield packed()

    return work


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[pa.RecordBatch]]]:
    """Successive rows that agree in the keys; the rows are sorted by them."""
    now, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        change = np.any([np.diff(c) != 0 for c in columns], axis=0)
        bounds = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for low, high in zip(bounds, bounds[1:]):
            key = tuple(int(c[low]) for c in columns)
            if key != now and parts:
                yield now, parts
                parts = []
            now = key
            parts.append(batch.slice(low, high - low))
    if parts:
        yield now, parts


def _build(folder: str):
    """Writes the perfect hash of each shard; gives (shard, n)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (shard,), parts in _grouped(batches, ["shard"]):
            keys = np.concatenate([p.column("pair").to_numpy() for p in parts]).view(np.uint64)
            stores.write(folder, f"pairs-{shard}", perfect_hash.build(keys))
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([len(keys)], pa.int64())], ["shard", "n"])

    return work


def _dense(folder: str):
    """The counts of a task as one vector for each shard, in the order of its hash."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        branch = TaskContext.get().partitionId() % BRANCHES
        for (shard,), parts in _grouped(batches, ["shard"]):
            index = stores.read(folder, f"pairs-{shard}")
            vector = np.zeros(len(index["keys"]), dtype=np.int64)
            for part in parts:
                at = perfect_hash.find(index, part.column("pair").to_numpy().view(np.uint64))
                if (at < 0).any():
                    raise ValueError(f"shard {shard} lacks a pair that was counted")
                np.add.at(vector, at, part.column("k").to_numpy())
            yield _vector(shard, branch, vector)

    return work


def _vector(shard: int, branch: int, vector: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array([shard], pa.int64()), pa.array([branch], pa.int64()), pa.array([vector.tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["shard", "branch", "vector"])


def _added(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, np.ndarray]]:
    """The sum of the vectors of each key, one vector after another."""
    now, total = None, None
    for batch in batches:
        for *key, data in zip(*[batch.column(k).to_pylist() for k in keys], batch.column("vector")):
            vector = np.frombuffer(data.as_buffer(), dtype=np.int64)
            if key != now:
                if now is not None:
                    yield tuple(now), total
                now, total = key, vector.copy()
            else:
                total += vector
    if now is not None:
        yield tuple(now), total


def _branches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (shard, branch), total in _added(batches, ["shard", "branch"]):
        yield _vector(shard, branch, total)


def _totals(folder: str, size_b: int):
    """Writes each shard's counts; gives (a, top), the largest count of an A id in it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (shard,), total in _added(batches, ["shard"]):
            stores.write(folder, f"counts-{shard}", {"counts": total})
            a = (stores.read(folder, f"pairs-{shard}")["keys"] // np.uint64(size_b)).astype(np.int64)
            order = np.argsort(a, kind="stable")
            ids, start = np.unique(a[order], return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.maximum.reduceat(total[order], start))], ["a", "top"])

    return work


@dataclass
class Counts:
    """Where the pairs' counts are, the number of shards and of pairs, and each A id's largest count."""

    folder: str
    shards: int
    pairs: int
    top: np.ndarray
    filled: frozenset[int]  # shards that have pairs

    def of(self, pair: np.ndarray) -> np.ndarray:
        """The count of each pair; 0 for one that was never linked."""
        shard = _shard(_slot(pair), self.shards)
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(self.shards + 1))
        out = np.zeros(len(pair), dtype=np.int64)
        for s in np.flatnonzero(np.diff(bounds)).tolist():
            if s in self.filled:
                own = order[bounds[s] : bounds[s + 1]]
                at = perfect_hash.find(stores.read(self.folder, f"pairs-{s}"), pair[own])
                out[own] = np.where(at < 0, 0, stores.read(self.folder, f"counts-{s}")["counts"][at])
        return out


def count(docs: DataFrame, own: Vocabularies, *, text: str = "text") -> Counts:
    """Counts the documents that hold each pair linked."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/pairs-{uuid.uuid4().hex}"
    partial = cut(docs.select(text).mapInArrow(_pair_counts(_on_worker(docs, own), text), "slot bigint, pair bigint, k bigint"))
    rows, about = partial.agg(F.count("*"), F.approx_count_distinct("pair")).first()
    shards = min(max(LEAST_SHARDS, about // SHARD), SLOTS)
    shard = _shard(F.col("slot"), shards).alias("shard")
    tasks = max(1, min(shards, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    distinct = partial.select(shard, "pair").repartition(tasks, "shard").distinct().sortWithinPartitions("shard")
    built = distinct.mapInArrow(_build(folder), "shard bigint, n bigint").collect()  # a row for each shard
    wide = max(spark.sparkContext.defaultParallelism, 2 * rows // max(about, 1))  # sums of fewer pairs would be mostly zeros
    sums = partial.select(shard, "pair", "k").coalesce(int(wide)).sortWithinPartitions("shard")
    vectors = sums.mapInArrow(_dense(folder), "shard bigint, branch bigint, vector binary")
    vectors = vectors.repartition(tasks, "shard", "branch").sortWithinPartitions("shard", "branch")
    vectors = vectors.mapInArrow(_branches, "shard bigint, branch bigint, vector binary")
    vectors = vectors.repartition(tasks, "shard").sortWithinPartitions("shard")
    tops = vectors.mapInArrow(_totals(folder, own.size_b), "a bigint, top bigint").groupBy("a").agg(F.max("top").alias("top"))
    top = np.zeros(own.size_a, dtype=np.int64)
    for r in tops.collect():  # a row for each A id
        top[r.a] = r.top
    return Counts(folder, shards, sum(r.n for r in built), top, frozenset(r.shard for r in built))


def align(docs: DataFrame, own: Vocabularies, counts: Counts, *, text: str = "text", added: str = "links") -> DataFrame:
    """The documents with a struct column `added`: tokens of both sides, groups, links, and what the counts say of them."""
    cutter = _on_worker(docs, own)

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        parts = []
        for run in _runs(batch.column(text)):
            words, texts_of = cutter().look(run)
            owner, pair, times = pairs_by_text(cutter(), words, texts_of)
            distinct, back = np.unique(pair, return_inverse=True)
            value = counts.of(distinct)
            best = value == counts.top[(distinct // np.uint64(own.size_b)).astype(np.int64)]
            sums = np.zeros((6, len(run)), dtype=np.int64)
            for row, values in zip(sums, cutter().counts[words].T):
                np.add.at(row, texts_of, values)
            np.add.at(sums[4], owner, times * best[back])
            np.add.at(sums[5], owner, times * value[back])
            parts.append([*sums, digests(cutter(), words, texts_of, len(run))])
        return [pa.array(np.concatenate(x)) if not isinstance(x[0], list) else pa.array(sum(x, [])) for x in zip(*parts)]

    return by_batch(docs, added, DIGEST, work)
