"""The registered queries against their SQL, brute force, or held-out labels."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from gondola.llm import chat, language_model
from gondola.llm.oracles import ORACLES
from gondola.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


def by_id(frame):
    found = {r.doc_id: r for r in frame.collect()}
    assert len(found) == frame.count()
    return found


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    frame = REGISTRY[name](spark, SF)
    relation = connection.sql(ORACLES[name])
    assert sorted(relation.columns) == sorted(frame.columns)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    wanted = sorted(relation.project(", ".join(frame.columns)).fetchall(), key=key)
    assert sorted(map(tuple, frame.collect()), key=key) == wanted


def test_mix_comes_near_its_targets(spark):
    rows = REGISTRY["op1_pareto_mix"](spark, "/root/testdata/sf0.01").collect()
    sources = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source").collect()
    source = {r.doc_id: r.source for r in sources}
    taken, target, largest = Counter(), {}, defaultdict(int)
    for r in rows:
        assert r.taken in (0, r.size, 2 * r.size)
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        largest[source[r.doc_id]] = max(largest[source[r.doc_id]], r.size)
    assert all(abs(taken[s] - t) <= largest[s] / 2 for s, t in target.items())
    assert sum(target.values()) == pytest.approx(1.5 * sum(r.size for r in rows))


def test_conversations_read_back(spark):
    found = {r.conv_id: r for r in REGISTRY["op3_chat_format"](spark, SF).collect()}
    said = "</s>[INST] ok [/INST]"
    turns = defaultdict(list, {-7: [(0, "user", said), (1, "assistant", said)]})
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    assert found.keys() == turns.keys()
    for key, own in turns.items():
        own.sort()
        digest = hashlib.sha256("".join(f"{role}\n{text}\n" for _, role, text in own).encode()).hexdigest()
        loss = "".join(text for _, role, text in own if role == "assistant")
        r = found[key]
        assert (r.n_turns, r.turns_sha256, r.loss_chars) == (len(own), digest, len(loss))
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        written = "".join(f"<|{chat.escape(role)}|>{chat.escape(text)}</s>" for _, role, text in own)
        assert r.formatted_chars == len(written)


@pytest.mark.parametrize("name, label, folds, held, least", [("op5_quality_trees", "quality", 4, 2, 0.97), ("op6_toxicity_ftrl", "toxic", 5, 0, 0.92)])
def test_models_hold_on_unseen_documents(spark, name, label, folds, held, least):
    folder = "/root/testdata/sf0.1"
    scored = REGISTRY[name](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = scored.join(labels, "doc_id").collect()
    assert scored.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held) and 0 <= r.score <= 1 for r in rows)
    unseen = [r for r in rows if r.held_out]
    right = sum(r.predicted == r[label] for r in unseen) / len(unseen)
    guess = max(Counter(r[label] for r in unseen).values()) / len(unseen)
    assert right >= least and right > guess


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute_groups(sets, percent=85):
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, i in enumerate(ids):
        for j in ids[:n]:
            common = len(sets[i] & sets[j])
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def test_groups_equal_brute_force(spark, texts):
    found = by_id(REGISTRY["op7_setsketch_dedup"](spark, SF))
    sets = {i: shingles(t) for i, t in texts.items()}
    wanted = brute_groups(sets)
    assert {i: r.component_id for i, r in found.items()} == wanted
    assert all(r.n_shingles == len(sets[i]) and r.kept == (i == wanted[i]) for i, r in found.items())


def statistics(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    again = {p for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for p in range(k, k + 5)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again)


def test_rule_statistics_equal_brute_force(spark, texts):
    found = by_id(REGISTRY["op8_weak_rules"](spark, SF))
    for i, text in texts.items():
        r = found[i]
        n, *_, again = own = statistics(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == own
        assert r.base_failed == (n < 10 or 100 * again > 20 * n)
        assert not (r.base_failed and r.kept)


def test_token_counts_equal_an_independent_unigram_tokenizer(spark, texts):
    from tokenizers import Tokenizer, models, pre_tokenizers

    from gondola.llm import queries, token_counts

    pieces = token_counts.load_pieces(queries.vocabulary(spark, "piece_bpe_32k.model"))
    unknown = min(pieces.values()) - 10
    other = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces.items()], 0))
    other.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    segmenter = token_counts.Segmenter(pieces)
    words = sorted({token_counts.MARK + w for t in texts.values() for w in WORD.findall(t or "")})
    covered = [w for w in words if all(c in pieces for c in w)]
    assert len(covered) > 0.9 * len(words) and unknown < 0
    mine = segmenter.counts(covered)
    score = lambda parts: sum(pieces[p] for p in parts)
    for word, count in zip(covered, mine):
        theirs = other.encode(word).tokens
        best = score(theirs)
        assert count == len(theirs) or best == pytest.approx(score_of(word, pieces)[0])
    found = by_id(REGISTRY["op9_token_counts"](spark, SF))
    counts = dict(zip(words, segmenter.counts(words)))
    for i, text in texts.items():
        own = [counts[token_counts.MARK + w] for w in WORD.findall(text or "")]
        assert (found[i].n_words, found[i].n_tokens, found[i].most_tokens) == (len(own), sum(own), max(own, default=0))


def score_of(word, pieces):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        best.append(max((best[k][0] + pieces[word[k:end]], best[k][1] - 1) for k in range(end) if word[k:end] in pieces))
    return best[-1]


def test_trie_shared_counts_equal_one_by_one(texts):
    from gondola.llm import token_counts

    pieces = {"\u2581": -1.0, "a": -2.0, "b": -2.5, "ab": -3.0, "\u2581a": -2.0, "bab": -4.0}
    words = sorted({"\u2581" + w for w in ("a", "ab", "aba", "abab", "ababab", "b", "ba", "zz", "a中", "ab中b")})
    alone = [token_counts.Segmenter(pieces).counts([w])[0] for w in words]
    assert token_counts.Segmenter(pieces).counts(words) == alone
    for word, count in zip(words, alone):
        if all(c in pieces for c in word):
            assert count == -score_of(word, pieces)[1]
    assert alone[words.index("\u2581zz")] == 3 and alone[words.index("\u2581a中")] == 4


def brute_model(tokens, order):
    """P(token | the `order` - 1 tokens before it) by dictionaries, from lists of tokens without their starts."""
    grams = [None, *[Counter() for _ in range(order)]]
    for own in tokens:
        padded = [1] * (order - 1) + own
        grams[order].update(tuple(padded[k : k + order]) for k in range(len(own)))
    for k in range(order - 1, 0, -1):
        grams[k].update(g[1:] for g in grams[k + 1])  # each longer one once
    often = lambda counts: [sum(n == k for n in counts.values()) for k in (1, 2, 3, 4)]
    d = [None, *[language_model.discounts(often(grams[k])) for k in range(1, order + 1)]]
    context = defaultdict(lambda: [0, 0, 0, 0])
    for k in range(1, order + 1):
        for g, n in grams[k].items():
            context[g[:-1]][0] += n
            context[g[:-1]][min(n, 3)] += 1

    def p(history, w):
        k = len(history) + 1
        lower = p(history[1:], w) if history else 1 / (len(grams[1]) + 1)
        if history not in context:
            return lower
        whole, *kinds = context[history]
        n = grams[k].get((*history, w), 0)
        return (n - d[k][min(n, 3) - 1] if n else 0) / whole + sum(a * b for a, b in zip(d[k], kinds)) / whole * lower

    return p


@pytest.mark.parametrize("order", [2, 3, 4])
def test_language_model_equals_brute_force(spark, texts, order):
    tokens = {i: [*WORD.findall((t or "").translate(LOWER)), 0] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    if order == 2:
        found = by_id(REGISTRY["op10_kneser_ney"](spark, SF))
    else:
        docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
        known = spark.createDataFrame([(i, h) for i, h in held.items()], "doc_id bigint, held_out boolean")
        docs = docs.join(known, "doc_id")
        model = language_model.train(docs.where("not held_out"), order=order, shards=5)
        found = by_id(language_model.score(docs, model).select("doc_id", "held_out", "lm.*", F.lit(model.tokens).alias("train_tokens")))
    training = [own for i, own in tokens.items() if not held[i]]
    one = Counter(w for own in training for w in own)
    total, vocabulary = sum(one.values()), len(one)
    p = brute_model(training, order)
    for history in (("the",), (1,), ("never seen",)):
        history = (1,) * (order - 2) + history
        assert sum(p(history, w) for w in one) + p(history, "unknown") == pytest.approx(1)
    for i, own in tokens.items():
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(own), sum(w in one for w in own), total)
        assert r.base_score == pytest.approx(sum(math.log10((one.get(w, 0) + 1) / (total + vocabulary + 1)) for w in own))
        padded = [1] * (order - 1) + own
        assert r.score == pytest.approx(sum(math.log10(p(tuple(padded[k : k + order - 1]), w)) for k, w in enumerate(own)))
    unseen = [r for i, r in found.items() if held[i]]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)
