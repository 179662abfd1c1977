"""Byte-level BPE encoding and decoding (13) with a hierarchical-bitmap rank queue.

A text is cut into pre-tokens by a pattern. A pre-token that is itself a token stays whole; any other starts as single
bytes in a linked list, and the neighbours whose joined bytes have the lowest rank are merged, leftmost
first, until no neighbours have a rank. The queue has a bucket of positions for each rank that is waiting
and a bitmap of such ranks in three levels of 64-bit words: find-first-set in each level gives the next
rank, whatever the number of positions. Merging leaves entries of former neighbours behind; an entry counts
only if its position still has that rank. A bucket is taken whole and sorted; if a merge gives rise to a lower rank, the
rest of it goes back. So n bytes take O(n log n) steps at most (the logarithm for the order inside a bucket),
which keeps a text without any blank cheap. The pre-tokens of some texts that are not known yet share one
queue: their lists are apart, so they don't disturb each other.

Workers remember the ids of short pre-tokens: those met since, or among, the last `CACHE` new ones; long ones
are encoded each time. Texts never meet in a shuffle. A text of over `PART` characters is taken in parts, so
memory follows the text and not the number of its tokens.

Defined results: a null or empty text has no ids. Repeated rows count alike. Bytes that are not UTF-8 are
read as U+FFFD. Empty tables give no rows. A column that is called like `added` is replaced.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gondola.llm.common import by_batch, texts

#: The pattern that parts pre-tokens for the public rank files. Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: New pre-tokens after which a worker forgets what it has not met meanwhile, and the most characters of one.
CACHE, SHORT = 600_000, 32
#: Characters of texts that are encoded together, and pre-tokens of a part of a longer text.
PART = 1 << 19


def load_ranks(path: str) -> dict[bytes, int]:
    """Token and rank (its id) from a file with a base64 token and its rank per line. At most 2**20 tokens."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    if len(ranks) > 1 << 20:
        raise ValueError(f"{len(ranks)} tokens are too many to broadcast")
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"no token for the bytes {missing[:5]} of {path}")
    return ranks


class RankQueue:
    """Positions by rank, the lowest rank first."""

    def __init__(self, ranks: int):
        words = (ranks >> 6) + 1
        self.buckets: dict[int, list[int]] = {}
        self.low = [0] * words
        self.mid = [0] * ((words >> 6) + 1)
        self.top = 0

    def put(self, rank: int, positions: list[int]) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket += positions
            return
        self.buckets[rank] = positions
        word = rank >> 6
        self.low[word] |= 1 << (rank & 63)
        self.mid[word >> 6] |= 1 << (word & 63)
        self.top |= 1 << (word >> 6)

    def take(self) -> tuple[int, list[int]]:
        """The next rank and its positions in order; the queue must not be empty (`top` is 0 then)."""
        group = (self.top & -self.top).bit_length() - 1
        word = self.mid[group]
        word = group << 6 | (word & -word).bit_length() - 1
        bits = self.low[word]
        rank = word << 6 | (bits & -bits).bit_length() - 1
        self.low[word] = bits = bits & (bits - 1)
        if not bits:
            self.mid[group] &= self.mid[group] - 1
            if not self.mid[group]:
                self.top &= self.top - 1
        bucket = self.buckets.pop(rank)
        bucket.sort()
        return rank, bucket


class Encoder:
    """Ids of texts and bytes of ids. `pattern` finds the pre-tokens (all of a text's characters)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.queue = RankQueue(max(ranks.values()) + 1)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.double = np.full(1 << 16, -1, dtype=np.int64)
        for token, rank in ranks.items():
            if len(token) == 2:
                self.double[token[0] << 8 | token[1]] = rank
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}  # what was known when `known` was emptied last
        self.long: dict[str, bytes] = {}

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each pre-token's bytes, as unsigned 32-bit integers."""
        get, queue, waiting = self.ranks.get, self.queue, self.queue.buckets
        data = b"".join(pieces)
        stops = np.cumsum([len(piece) for piece in pieces])
        raw = np.frombuffer(data, dtype=np.uint8).astype(np.int64)
        pair = np.append(self.double[raw[:-1] << 8 | raw[1:]], -1)
        pair[stops - 1] = -1
        at = np.flatnonzero(pair >= 0)
        at = at[np.argsort(pair[at], kind="stable")]
        ranks, low = np.unique(pair[at], return_index=True)
        for rank, positions in zip(ranks.tolist(), np.split(at, low[1:])):
            queue.put(rank, positions.tolist())
        begins = bytearray(len(data) + 1)  # whether a pre-token begins
        begins[0] = 1
        for stop in stops.tolist():
            begins[stop] = 1
        token, pair = self.single[raw].tolist(), pair.tolist()
        end = list(range(1, len(data) + 1))  # where the token that begins at a position ends: the next one's position
        before = list(range(-1, len(data) - 1))
        alive = bytearray(b"\1") * len(data)
        while queue.top:
            rank, bucket = queue.take()
            for k, p in enumerate(bucket):
                if pair[p] != rank:
                    continue  # stale: the token or its neighbour has been merged since
                gone = end[p]
                stop = end[p] = end[gone]
                alive[gone] = 0
                token[p] = rank
                pair[gone] = pair[p] = -1
                least = rank
                if not begins[stop]:
                    before[stop] = p
                    new = get(data[p : end[stop]])
                    if new is not None:
                        pair[p] = least = new
                        if new in waiting:
                            waiting[new].append(p)
                        else:
                            queue.put(new, [p])
                if not begins[p]:
                    o = before[p]
                    new = get(data[o:stop])
                    if new is None:
                        pair[o] = -1
                    else:
                        pair[o] = new
                        if new < least:
                            least = new
                        if new in waiting:
                            waiting[new].append(o)
                        else:
                            queue.put(new, [o])
                if least < rank:
                    queue.put(rank, bucket[k + 1 :])
                    break
        first = np.flatnonzero(np.frombuffer(alive, dtype=np.uint8))
        ids = np.array(token, dtype=np.uint32)[first].tobytes()
        bounds = (4 * np.searchsorted(first, np.concatenate([[0], stops]))).tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    def learn(self, pieces: Iterable[str]) -> None:
        """Finds the ids of pre-tokens that are not known; those of long ones are kept until the next call."""
        if len(self.known) > CACHE:
            self.before, self.known = self.known, {}
        self.long = {}
        known, before, ranks, new = self.known, self.before, self.ranks, []
        for piece in dict.fromkeys(pieces):
            if piece not in known:
                if piece in before:
                    known[piece] = before[piece]
                elif (data := piece.encode("utf-8", "replace")) in ranks:
                    known[piece] = np.uint32(ranks[data]).tobytes()
                else:
                    new.append((piece, data))
        if new:
            for (piece, _), ids in zip(new, self.merge([data for _, data in new])):
                (known if len(piece) <= SHORT else self.long)[piece] = ids

    def packed(self, pieces: list[str]) -> bytes:
        """The ids of successive pre-tokens, all of them learned, as unsigned 32-bit integers of this machine."""
        known, long = self.known, self.long
        try:
            return b"".join([known[piece] for piece in pieces])
        except KeyError:
            return b"".join([known[piece] if piece in known else long[piece] for piece in pieces])

    def encode(self, texts: Iterable[str]) -> Iterator[tuple[int, np.ndarray]]:
        """(text, ids) of the texts in order; those of a long text come in parts. Texts are taken some `PART`
        characters at a time, so that what is new in them shares a queue."""
        waiting: list[tuple[int, list[str]]] = []
        size = 0

        def done() -> Iterator[tuple[int, np.ndarray]]:
            self.learn(chain.from_iterable(pieces for _, pieces in waiting))
            for k, pieces in waiting:
                yield k, np.frombuffer(self.packed(pieces), dtype=np.uint32).astype("<u4", copy=False)
            waiting.clear()

        for k, text in enumerate(texts):
            found = [self.pattern.findall(text)] if len(text) <= PART else self._parts(text)
            for pieces in found:
                waiting.append((k, pieces))
                size += min(len(text), PART)
                if size >= PART:
                    yield from done()
                    size = 0
        yield from done()

    def _parts(self, text: str) -> Iterator[list[str]]:
        found = self.pattern.finditer(text)
        while part := [m.group() for m in islice(found, PART)]:
            yield part

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))


_encoders: dict[str, Encoder] = {}


def _on_worker(docs: DataFrame, ranks: dict[bytes, int], pattern: str):
    """Gives the worker's encoder, one a broadcast."""
    sent = docs.sparkSession.sparkContext.broadcast((ranks, pattern))
    name = str(sent._jbroadcast.id())

    def encoder() -> Encoder:
        if name not in _encoders:
            _encoders.clear()
            _encoders[name] = Encoder(*sent.value)
        return _encoders[name]

    return encoder


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, text: str = "text", added: str = "bpe") -> DataFrame:
    """The documents with a struct column `added`: ids (array of int)."""
    encoder = _on_worker(docs, ranks, pattern)

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        found = list(encoder().encode(texts(batch.column(text))))
        counts = np.bincount([k for k, _ in found], [len(ids) for _, ids in found], batch.num_rows)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        flat = np.concatenate([ids for _, ids in found]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]

    return by_batch(docs, added, "ids array<int>", work)


def decode(rows: DataFrame, ranks: dict[bytes, int], *, ids: str = "ids", added: str = "decoded") -> DataFrame:
    """The rows with a struct column `added`: data (binary), the bytes of each row's ids.

    A null list has null data; an id outside the vocabulary is an error.
    """
    encoder = _on_worker(rows, ranks, "")

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        lists = batch.column(ids)
        return [pa.array([None if x.as_py() is None else encoder().decode(np.array(x.as_py(), dtype=np.int64)) for x in lists], pa.binary())]

    return by_batch(rows, added, "data binary", work)


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, text: str = "text", added: str = "bpe") -> DataFrame:
    """The documents with a struct column `added`: n_tokens, ids_sha256, decoded_sha256.

    Each part of a text is encoded, hashed, decoded from its ids and hashed again, so the ids are never kept.
    """
    encoder = _on_worker(docs, ranks, pattern)

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        own = encoder()
        out = [[0, hashlib.sha256(), hashlib.sha256()] for _ in range(batch.num_rows)]
        for k, ids in own.encode(texts(batch.column(text))):
            out[k][0] += len(ids)
            out[k][1].update(ids.tobytes())
            out[k][2].update(own.decode(ids))
        n, a, b = zip(*[(count, x.hexdigest(), y.hexdigest()) for count, x, y in out])
        return [pa.array(n, pa.int64()), pa.array(a), pa.array(b)]

    return by_batch(docs, added, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", work)
