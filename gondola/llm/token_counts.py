"""Token counts (9): unigram segmentation by trie-shared dynamic programming.

A text's pre-tokens are its words, each with a word-start mark in front. A pre-token's segmentation is the one
of pieces with the highest sum of scores (of equal sums: the fewest pieces); its forward scores at a
position depend on the characters before it only. So the distinct pre-tokens of a batch are put in order,
which walks their trie depth first: what two neighbours share in front is scored once and taken off the
stack, and the score at a pre-token's end gives its count. Counts of up to `CACHE` pre-tokens are kept from
batch to batch. Texts never meet in a shuffle.

The pieces are a public tokenizer's; as that file ranks pieces and has no probabilities, the piece of rank r
scores -log(r + 1) - log(harmonic number), a Zipf law. A character that no piece covers costs one byte token
per UTF-8 byte, each `UNKNOWN` below the lowest score.

Defined results: null, empty and blank texts have no words and no tokens. Repeated rows count alike.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gondola.llm import words as W
from gondola.llm.common import by_batch

MARK = "\u2581"
UNKNOWN = 10.0
CACHE = 1_000_000


def load_pieces(path: str) -> dict[str, float]:
    """Piece and score from a sentencepiece file; control and byte pieces are left out. At most 2**20 pieces."""
    import sentencepiece

    reader = sentencepiece.SentencePieceProcessor(model_file=path)
    size = reader.get_piece_size()
    if size > 1 << 20:
        raise ValueError(f"{size} pieces are too many to broadcast")
    ids = [i for i in range(size) if not (reader.is_control(i) or reader.is_unknown(i) or reader.is_byte(i) or reader.is_unused(i))]
    total = math.log(sum(1 / k for k in range(1, len(ids) + 1)))
    return {reader.id_to_piece(i): -math.log(k) - total for k, i in enumerate(ids, 1)}


class Segmenter:
    """Counts pieces of pre-tokens; keeps what it has counted by word hash."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=0)
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN
        self.known_hashes = np.empty(0, dtype=np.uint64)
        self.known_counts = np.empty(0, dtype=np.int64)

    def counts(self, pretokens: list[str]) -> list[int]:
        """The token count of each pre-token; the list must be sorted and without repeats."""
        pieces, longest = self.pieces, self.longest
        score, tokens, out, before = [0.0], [0], [], ""
        for text in pretokens:
            shared, most = 0, min(len(text), len(before))
            while shared < most and text[shared] == before[shared]:
                shared += 1
            del score[shared + 1 :], tokens[shared + 1 :]
            for end in range(shared + 1, len(text) + 1):
                size = len(text[end - 1].encode("utf-8", "surrogatepass"))
                best, fewest = score[end - 1] + size * self.unknown, tokens[end - 1] + size
                for start in range(max(0, end - longest), end):
                    own = pieces.get(text[start:end])
                    if own is not None:
                        own += score[start]
                        if own > best or own == best and tokens[start] + 1 < fewest:
                            best, fewest = own, tokens[start] + 1
                score.append(best)
                tokens.append(fewest)
            out.append(tokens[-1])
            before = text
        return out

    def run(self, run: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By text: words, tokens, and the tokens of the word with most."""
        distinct, first, back = np.unique(run.hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known_hashes, distinct)
        at[at == len(self.known_hashes)] = 0
        known = self.known_hashes[at] == distinct if len(self.known_hashes) else np.zeros(len(distinct), dtype=bool)
        count = np.zeros(len(distinct), dtype=np.int64)
        count[known] = self.known_counts[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            texts = [MARK + run.word(k).decode("utf-8", "replace") for k in first[new]]
            order = sorted(range(len(new)), key=texts.__getitem__)
            count[new[order]] = self.counts([texts[k] for k in order])
            self._remember(distinct[new], count[new])
        each = count[back]
        sums = np.concatenate([[0], np.cumsum(each)])[run.first]
        most = np.zeros(run.texts, dtype=np.int64)
        np.maximum.at(most, run.owner, each)
        return np.diff(run.first), np.diff(sums), most

    def _remember(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        if len(self.known_hashes) + len(hashes) > CACHE:
            self.known_hashes, self.known_counts = self.known_hashes[:0], self.known_counts[:0]
        hashes = np.concatenate([self.known_hashes, hashes])
        order = np.argsort(hashes)
        self.known_hashes, self.known_counts = hashes[order], np.concatenate([self.known_counts, counts])[order]


_segmenters: dict[str, Segmenter] = {}


def count(docs: DataFrame, pieces: dict[str, float], *, text: str = "text", added: str = "tokens") -> DataFrame:
    """The documents with a struct column `added`: n_words, n_tokens, most (tokens of one word)."""
    sent = docs.sparkSession.sparkContext.broadcast(pieces)
    name = str(sent._jbroadcast.id())  # workers keep one segmenter a broadcast

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        if name not in _segmenters:
            _segmenters.clear()
            _segmenters[name] = Segmenter(sent.value)
        parts = [_segmenters[name].run(run) for run in W.runs(batch.column(text), lower=False)]
        return [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*parts)]

    return by_batch(docs, added, "n_words bigint, n_tokens bigint, most bigint", work)
