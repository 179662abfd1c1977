"""Whitening, alignment and byte-level BPE against plain versions and the public libraries."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from llm.conftest import make
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gondola.llm import alignment, byte_bpe, perfect_hash, stores, whitening
from gondola.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def noise(seed, alphabets=("ab ", "a \n", "é ▁x</s>", "<|endoftext|> ", "0x41<>\t  ﬁ漢", "it's  we'll\n\n a1 ")):
    random_ = random.Random(seed)
    return ["".join(random_.choice(letters) for _ in range(n)) for letters in alphabets for n in (1, 2, 3, 10, 50, 400) for _ in range(8)]


# --- byte-level BPE ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.load_ranks(RANKS)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(encoder, text):
    return [i for _, part in encoder.encode([text]) for i in part.tolist()]


def test_ids_equal_the_library(ranks, library):
    encoder = byte_bpe.Encoder(ranks, byte_bpe.PATTERN)
    assert byte_bpe.PATTERN == public_tokenizers.PATTERN
    every = [f"a{chr(c)}1{chr(c)}\n{chr(c)} {chr(c)}{chr(c)}!" for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    for text in [*noise(1), *every]:
        ids = ids_of(encoder, text)
        assert ids == library.encode_ordinary(text)
        assert encoder.decode(np.array(ids, dtype=np.int64)) == text.encode()


def test_very_long_pretokens(ranks, library):
    encoder = byte_bpe.Encoder(ranks, byte_bpe.PATTERN)
    random_ = random.Random(4)
    for text in ("a" * 100_000, "".join(random_.choice("abcdefgh") for _ in range(100_000)), " " * 50_000 + "x", "é" * 30_001):
        assert ids_of(encoder, text) == library.encode_ordinary(text)
        assert not encoder.queue.buckets and not encoder.queue.top and not any(encoder.queue.low) and not any(encoder.queue.mid)


def test_parts_and_cache_change_nothing(ranks, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "PART", 7)
    monkeypatch.setattr(byte_bpe, "CACHE", 3)
    encoder = byte_bpe.Encoder(ranks, byte_bpe.PATTERN)
    texts = noise(2)
    found = [[] for _ in texts]
    for k, ids in encoder.encode(texts):
        found[k] += ids.tolist()
    assert found == [library.encode_ordinary(text) for text in texts]


def test_lower_ranks_that_arise_later_come_first():
    ranks = {bytes([b]): 1000 + b for b in range(256)} | {b"abc": 1, b"bc": 2, b"ab": 3, b"aa": 4, b"aaa": 5, b"aaaa": 0}
    encoder = byte_bpe.Encoder(ranks, r"\S+|\s+")
    other = tiktoken.Encoding("x", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    random_ = random.Random(9)
    for _ in range(500):
        text = "".join(random_.choice("aaabc") for _ in range(random_.randrange(1, 40)))
        assert ids_of(encoder, text) == other.encode_ordinary(text)


def test_the_queue_gives_ranks_and_positions_in_order():
    queue, random_ = byte_bpe.RankQueue(200_000), random.Random(3)
    pushed = [(random_.randrange(200_001), random_.randrange(1000)) for _ in range(5000)]
    for rank, position in pushed:
        queue.put(rank, [position])
    found = []
    while queue.top:
        rank, positions = queue.take()
        found += [(rank, p) for p in positions]
    assert found == sorted(pushed)


def test_bpe_query_equals_the_library(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = REGISTRY["op13_byte_bpe"](spark, SF).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_of_odd_rows(spark, ranks, odd_docs, no_docs):
    encoded = byte_bpe.encode(odd_docs, ranks, byte_bpe.PATTERN, added="_o")
    assert encoded.columns == [*odd_docs.columns, "_o"]
    told = byte_bpe.decode(encoded.select("doc_id", "text", "_o.ids"), ranks)
    for r in told.select("text", "ids", F.col("decoded.data").alias("data")).collect():
        assert bytes(r.data).decode() == (r.text or "") and (r.text or not r.ids)
    digests = byte_bpe.digests(odd_docs, ranks, byte_bpe.PATTERN, added="_o")
    assert {r.n for r in digests.where("text is null or text = ''").select(F.col("_o.n_tokens").alias("n")).collect()} == {0}
    assert byte_bpe.digests(no_docs, ranks, byte_bpe.PATTERN).count() == 0 and byte_bpe.encode(no_docs, ranks, byte_bpe.PATTERN).count() == 0
    assert byte_bpe.decode(spark.createDataFrame([(None,)], "ids array<int>"), ranks).first().decoded.data is None


def test_ranks_without_a_byte_are_refused(tmp_path):
    (tmp_path / "few").write_text("YQ== 0\nYg== 1\n")
    with pytest.raises(ValueError, match="no token for the bytes"):
        byte_bpe.load_ranks(str(tmp_path / "few"))


# --- alignment --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabularies():
    return alignment.load(A, B)


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain(libraries, text):
    """(ids, end offsets) of both sides by the libraries; None if their bytes are not the text's."""
    a, b = libraries
    if not text:
        return None
    alphabet = alignment.byte_alphabet()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return None
    return ids_a, np.cumsum([len(x) for x in bytes_a]).tolist(), ids_b, np.cumsum([len(x) for x in bytes_b]).tolist()


def plain_links(cut):
    ids_a, ends_a, ids_b, ends_b = cut
    spans = lambda ends: list(zip([0, *ends], ends))
    out, first, starts_b = [], 0, [0, *ends_b]
    for i, (low, high) in enumerate(spans(ends_a)):
        while ends_b[first] <= low:
            first += 1
        j = first
        while j < len(ends_b) and starts_b[j] < high:
            out.append((ids_a[i], ids_b[j]))
            j += 1
    return out


def plain_groups(cut):
    ids_a, ends_a, ids_b, ends_b = cut
    out, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        parts = []
        for ids, ends, k in ((ids_a, ends_a, i), (ids_b, ends_b, j)):
            stop = ends.index(end, k) + 1
            parts.append((",".join(map(str, ids[k:stop])), stop))
        (one, i), (two, j) = parts
        out.append(f"{one}|{two}")
    return out


def brute_alignment(libraries, texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each text."""
    cuts = [plain(libraries, t) for t in texts]
    links = [plain_links(c) if c else [] for c in cuts]
    counts = defaultdict(int)
    for own in links:
        for pair in set(own):
            counts[pair] += 1
    top = defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    out = []
    for cut, own in zip(cuts, links):
        groups = plain_groups(cut) if cut else []
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        sizes = (len(cut[0]), len(cut[2])) if cut else (0, 0)
        out.append((*sizes, len(groups), len(own), sum(counts[p] == top[p[0]] for p in own), sum(counts[p] for p in own), digest))
    return out


COLUMNS = "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"


def test_both_sides_equal_the_libraries(vocabularies, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "CACHE", 3000)  # words are forgotten now and then
    cutter = alignment.Cutter(vocabularies)
    spaces = "\t\n\x0b\x0c\r\x1c\x1f\x85\xa0\u1680\u2003\u2028\u3000 "
    texts = [*noise(5), *noise(6), *noise(7, (spaces + "ab", spaces, "\n  a", "\r\n ;)}a", "\r a"))]
    texts += [f"x{chr(c)} {chr(c)}y  {chr(c)}" for c in range(1, 0x30000, 11) if not 0xD800 <= c < 0xE000]
    none = 0
    for start in range(0, len(texts), 50):
        run = ["", *texts[start : start + 50]]
        words, owner = cutter.look(run)
        found = alignment.digests(cutter, words, owner, len(run))
        for text, digest in zip(run, found):
            wanted = plain(libraries, text)
            none += wanted is None
            assert digest == (hashlib.sha256(";".join(plain_groups(wanted)).encode()).hexdigest() if wanted else "")
    assert 0 < none < len(texts) / 2


def test_alignment_query_equals_brute_force(spark, libraries):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    wanted = dict(zip([r.doc_id for r in rows], brute_alignment(libraries, [r.text for r in rows])))
    found = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in REGISTRY["op12_alignment"](spark, SF).collect()}
    assert found == wanted


def test_alignment_of_odd_rows(spark, vocabularies, libraries, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(alignment, "MERGE", 40)
    texts = [*noise(7)[::3], "</s> plain <s>", "<|endoftext|>", "▁x", "same", "same", None, ""]
    docs = odd_docs.select("doc_id", "text", *odd_docs.columns[3:]).unionByName(make(spark, [(100 + k, t, "x") for k, t in enumerate(texts)]).drop("source")).repartition(6)
    found = alignment.align(docs, vocabularies, alignment.count(docs, vocabularies), added="_o")
    assert found.columns == [*docs.columns, "_o"]
    rows = found.collect()
    wanted = brute_alignment(libraries, [r.text for r in rows])
    assert [tuple(r["_o"][c] for c in COLUMNS) for r in rows] == wanted
    nothing = alignment.count(no_docs, vocabularies)
    assert nothing.pairs == 0 and alignment.align(no_docs, vocabularies, nothing).count() == 0
    unknown = alignment.align(make(spark, [(1, "two words", "x")]), vocabularies, nothing).first().links  # counted nowhere
    assert (unknown.n_groups, unknown.count_sum) == (2, 0)


def test_counts_of_pairs_are_summed_over_tasks(spark, vocabularies):
    docs = make(spark, [(k, "one shared line", "x") for k in range(500)]).repartition(40)
    counts = alignment.count(docs, vocabularies)
    cutter = alignment.Cutter(vocabularies)
    a, b = (np.concatenate(side) for side in cutter.cut([" one", " shared", " line"]))
    pair = (a * vocabularies.size_b + b).astype(np.uint64)
    assert counts.of(pair).tolist() == [500] * len(pair) and counts.top[a].tolist() == [500] * len(a)
    assert counts.of(pair + np.uint64(1)).tolist() == [0] * len(pair)


@pytest.mark.parametrize("size", [0, 1, 2, 77, 50_000])
def test_perfect_hash_is_minimal_and_verified(size):
    keys = np.unique(np.random.default_rng(size).integers(0, 2**63, size).astype(np.uint64))
    found = perfect_hash.build(keys)
    assert sorted(perfect_hash.find(found, keys).tolist()) == list(range(len(keys)))
    assert (perfect_hash.find(found, keys + np.uint64(2**63)) == -1).all()
    assert found["words"].nbytes * 8 <= 64 * 12 + 6 * size


def test_stores_read_what_was_written(tmp_path):
    arrays = {"a": np.arange(5, dtype=np.uint16), "b": np.empty(0, dtype=np.float64), "c": np.array([-1, 2**62])}
    stores.write(str(tmp_path), "x", arrays)
    stores.write(f"file://{tmp_path}", "x", arrays)
    found = stores.read(str(tmp_path), "x")
    assert all((found[k] == arrays[k]).all() and found[k].dtype == arrays[k].dtype for k in arrays)
    assert [p.name for p in tmp_path.iterdir()] == ["x"]


# --- whitening --------------------------------------------------------------------------


def brute_whitening(vectors):
    x = np.floor(256 * np.array(vectors, dtype=np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(0)
    value, vector = np.linalg.eigh(np.cov(fit.T.astype(float), bias=True))
    value, vector = value[::-1], vector[:, ::-1]
    z = (x - total / n) @ vector[:, :4] / np.sqrt(value[:4])
    return n, ((n * x - total) ** 2).sum(1), z, value[:4] / value.sum()


def assert_white(rows, key, vectors, components=4):
    n, deviation, z, share = brute_whitening(list(vectors.values()))
    place = {i: k for k, i in enumerate(vectors)}
    assert sorted((r[key], r.component) for r in rows) == sorted((i, c) for i in vectors for c in range(1, components + 1))
    sign = {}
    for r in rows:
        k, c = place[r[key]], r.component - 1
        assert (r.n, int(r.deviation)) == (n, deviation[k])
        if abs(z[k, c]) > 1e-6:
            assert sign.setdefault(c, math.copysign(1, r.whitened * z[k, c])) == math.copysign(1, r.whitened * z[k, c])
        assert abs(r.whitened) == pytest.approx(abs(z[k, c]), abs=1e-8)
        assert r.explained == pytest.approx(share[c], rel=1e-9) and r.identity_error < 1e-9


def test_whitening_query_equals_numpy(spark):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    assert_white(REGISTRY["op11_whitening"](spark, SF).collect(), "vec_id", vectors)


def vectors_of(spark, data):
    return spark.createDataFrame([(i, v, "x", 1.0) for i, v in data], "vec_id bigint, embedding array<float>, row string, at double")


def test_whitening_of_odd_rows(spark):
    random_ = np.random.default_rng(1)
    data = [(k, [float(c) for c in np.float32(random_.normal(size=6) * [9, 5, 3, 2, 1, 1])]) for k in range(200)]
    hot = [(1000 + k, data[0][1]) for k in range(300)]
    odd = [(1, None), (2, []), (3, [1.0] * 5 + [None]), (4, [1.0] * 5 + [math.nan]), (5, [math.inf] + [1.0] * 5), (6, [1.0, 2.0])]
    odd = [(2000 + i, v) for i, v in odd]
    frame = vectors_of(spark, data + hot + odd).repartition(5)
    found = whitening.whiten(frame)
    assert found.select("row.*").columns == frame.columns
    rows = found.select("row.vec_id", *[c for c in found.columns if c != "row"]).collect()
    assert_white(rows, "vec_id", dict(data + hot))
    twice = whitening.whiten(vectors_of(spark, data + data)).select("row.vec_id", "component", "n").collect()
    assert len(twice) == 2 * 4 * len(data) and {r.n for r in twice} == {len(data)}


def test_whitening_without_variance(spark):
    kind = "vec_id bigint, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3 + [(2, None)], kind)).count() == 0
    line = whitening.whiten(spark.createDataFrame([(k, [float(k), 2.0 * k, 5.0]) for k in range(10)], kind)).collect()
    assert {r.component for r in line} == {1} and len(line) == 10
    big = whitening.whiten(spark.createDataFrame([(k, [1e30 * k, 1.0]) for k in range(3)], kind)).collect()
    assert len(big) == 3


def test_deviations_beyond_64_bits_are_exact(spark):
    rows = spark.createDataFrame([(0, (1,), [2**40, -5]), (1, (2,), [7, 2**62])], "at bigint, row struct<a:int>, x array<bigint>")
    total, count = [2**41, 3], 1000
    found = {r.at: r.deviation for r in whitening.deviations(rows, total, count).collect()}
    assert int(found[0]) == (1000 * 2**40 - 2**41) ** 2 + (-5000 - 3) ** 2
    assert found[1] is None  # 10^38 and more


def test_sums_are_exact(spark):
    rows = spark.createDataFrame([([2**62, -(2**62), k],) for k in range(9)], "x array<bigint>")
    assert whitening.sums(rows, 3) == (9, [9 * 2**62, -9 * 2**62, 36])
