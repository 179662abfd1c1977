"""Edge rows, defined results and hard cases of each operator."""

import math
import random
import re
import textwrap
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from hypothesis import given, settings, strategies as st
from llm.conftest import make, prose
from llm.test_registered import brute_groups, shingles
from pyspark.sql import functions as F

from gondola.llm import chat, common, components, decontaminate, language_model, licences, mixing, near_dedup, quality_model, rules, template, token_counts, toxicity

BENCHMARK = "item_id bigint, text string"


def collected(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*(columns or ["*"])).collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


# --- mixing -----------------------------------------------------------------------------


def test_mix_of_odd_rows(odd_docs, no_docs):
    mixed = mixing.mix(odd_docs, added="mixed")
    assert mixed.count() == odd_docs.count() and mixed.columns == [*odd_docs.columns, "mixed"]
    found = mixed.select("doc_id", "text", "mixed.*").collect()
    assert all(r.taken == r.copies * r.size and r.taken <= 2 * r.size for r in found)
    assert {r.size for r in found if not (r.text or "").strip()} == {0}
    same = [r.taken for r in found if r.doc_id == 7]
    assert len(set(same)) == 1
    assert mixing.mix(no_docs).count() == 0
    assert collected(mixed, "doc_id", "text", "mixed.taken") == collected(mixing.mix(odd_docs.repartition(5), added="mixed"), "doc_id", "text", "mixed.taken")


def test_mix_without_words(spark):
    found = mixing.mix(make(spark, [(1, None, "a"), (2, " ", "b")])).select("mix.*").collect()
    assert [(r.size, r.target, r.taken) for r in found] == [(0, 0.0, 0)] * 2


def test_capped_targets_are_dealt_again(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 10)], "source string, size bigint")
    found = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert found["a"] == 20 and found[None] == 20
    assert found["b"] == pytest.approx((3030 - 40) * 2 / 3) and found["c"] == pytest.approx((3030 - 40) / 3)


def test_better_odds_are_taken_more_often(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'one two three' AS text", "IF(id < 3000, 'a', 'b') AS source", "id % 2 AS good")
    mixed = mixing.mix(docs, odds=F.col("good") * 3 + 1, weights=(1, 1), share=0.5).select("good", "mix.*").where("copies > 0 AND source_size = 9000")
    count = {r.good: r["count"] for r in mixed.groupBy("good").count().collect()}
    assert count[1] > 1.3 * count[0]
    assert abs(sum(count.values()) * 3 - 3000) <= 2


def test_a_group_of_repeats_is_split(spark):
    """4,000 rows of one source without ids, 5 words each; another source of which a third shares its key."""
    alike = spark.range(4000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'one two three four five' AS text", "'a' AS source", "CAST(id AS STRING) AS note")
    other = spark.range(3000).selectExpr("IF(id % 3 = 0, 7, id) AS doc_id", "'six seven eight' AS text", "'b' AS source", "'x' AS note")
    docs = alike.unionByName(other).repartition(7)
    for share in (0.5, 0.77, 1.5):
        rows = mixing.mix(docs, weights=(1, 1), share=share).select("doc_id", "source", "note", "mix.*").collect()
        assert len(rows) == 7000
        for source, size in (("a", 5), ("b", 3)):
            own = [r for r in rows if r.source == source]
            assert abs(sum(r.taken for r in own) - own[0].target) <= size / 2
            assert {r.taken for r in own} <= {0, size, 2 * size}
    again = mixing.mix(docs.coalesce(2), weights=(1, 1), share=0.77).select("doc_id", "mix.taken")
    assert collected(again) == collected(mixing.mix(docs, weights=(1, 1), share=0.77).select("doc_id", "mix.taken"))


# --- licences ---------------------------------------------------------------------------


def test_licences_of_odd_rows(spark, odd_docs, no_docs):
    assert licences.scan(odd_docs).where("licence.n_lines > 0").count() == 0
    assert licences.scan(no_docs).count() == 0
    docs = make(spark, [
        (1, "Prose here.\nRELEASED under the  MIT license!\nmore", "a"), (2, "all rights\nreserved", "a"),
        (3, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0.", "a"), (4, "the MIT License is mentioned in a long line of ordinary prose", "a"),
    ])
    found = {r.doc_id: (r.n_lines, r.name, r.line) for r in licences.scan(docs).select("doc_id", "licence.*").collect()}
    assert found == {1: (1, "MIT", 1), 2: (0, "reserved", -1), 3: (2, "CC-BY-NC-4.0", 0), 4: (0, None, None)}


def brute_licence(text, templates, limit):
    grams = lambda words: set(zip(words, words[1:]))
    split = lambda t: re.findall("[^\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f]+", t.lower())
    words, line = [], []
    for k, part in enumerate((text or "").split("\n")):
        words += split(part)
        line += [k] * (len(words) - len(line))
    found = []
    for name in sorted(templates):
        for own in (grams(split(t)) for t in templates[name]):
            for i in range(len(words)):
                for j in range(i + 2, len(words) + 1):
                    seen = grams(words[i:j])
                    value = 2 * len(seen & own) / (len(seen) + len(own))
                    if value >= limit:
                        found.append((-value, name, line[i] != line[j - 1], line[i] if line[i] == line[j - 1] else -1))
    top = min(found, default=(None, None, None, None))
    return len({m[3] for m in found if not m[2]}), top[1], top[0] and -top[0], top[3], sorted({m[1] for m in found})


@pytest.mark.parametrize("limit", [0.9, 0.6])
def test_windows_equal_brute_force(limit):
    random_ = random.Random(8)
    templates = {"x": ["a b c", "a b a b c d e"], "y": ["b c d e f g h i j k", "c c c"], "z": ["a"]}
    texts = [None, "", "a", "\n", "a b c"]
    for _ in range(150):
        words = []
        while len(words) < random_.randrange(1, 34):
            words += random_.choice([t.split() for ts in templates.values() for t in ts] + [[random_.choice("abcdefghijk")] for _ in range(4)])
        texts.append("".join(w + random_.choice([" ", " ", " ", ", ", "\n"]) for w in words))
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    columns = licences._column(batch, "text", licences.Scanner(templates, limit))
    assert list(zip(*(c.to_pylist() for c in columns))) == [brute_licence(t, templates, limit) for t in texts]


def test_notices_inside_lines_and_over_lines(spark):
    mit = textwrap.wrap(licences.TEMPLATES["MIT"][2], 76)
    docs = make(spark, [
        (1, 'Some words.\nLicensed under the Apache License, Version 2.0 (the "License");\nyou may', "a"),
        (2, "x = 1\n# Licensed under the Apache License,\n# Version 2.0. See below.", "a"), (3, "y\nCopyright 2024 Acme. All rights reserved. z", "a"),
        (4, "/*\n * The MIT License\n *\n" + "".join(f" * {line}\n" for line in mit) + " */\n" + prose(4, 400), "a"),
    ])
    found = {r.doc_id: (r.n_lines, r.name, r.dice, r.line) for r in licences.scan(docs).select("doc_id", "licence.*").collect()}
    assert found == {1: (1, "Apache-2.0", 1.0, 1), 2: (0, "Apache-2.0", 1.0, -1), 3: (1, "reserved", 1.0, 1), 4: (0, "MIT", 1.0, -1)}


def test_whole_licences_are_found_and_told_apart(spark):
    bodies = {name: max(texts, key=len) for name, texts in licences.TEMPLATES.items() if name != "reserved"}
    assert all(len(t.split()) > 100 for t in bodies.values())
    random_ = random.Random(4)
    data = {}
    for name, text in bodies.items():
        words = text.split()
        for k in random_.sample(range(len(words)), len(words) // 60):
            words[k] = "changed"
        data[name] = prose(1, 300) + "\n" + "\n".join(textwrap.wrap(" ".join(words), 80)) + "\n" + prose(2, 300)
    header = 'Copyright 2020 X\n// Licensed under the Apache License, Version 2.0 (the "License");\n// you may not use this file except in compliance with the License.'
    gpl = "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version {} of the License, or\n(at your option) any later version."
    data |= {"header": header, "gpl 2": gpl.format(2), "gpl 3": gpl.format(3)}
    found = {r.source: r for r in licences.scan(make(spark, [(k, t, s) for k, (s, t) in enumerate(data.items())])).select("source", "licence.*").collect()}
    assert all(name in found[name].names and found[name].dice >= 0.9 for name in bodies)
    assert all(found[name].name == name for name in bodies)
    assert [found[s].name for s in ("header", "gpl 2", "gpl 3")] == ["Apache-2.0", "GPL-2.0", "GPL-3.0"]


# --- chat -------------------------------------------------------------------------------


def rendered(text, **values):
    return "".join(p for p, _ in template.compile_template(text, {"escape": chat.escape})(values))


def test_templates_render():
    turns = [{"role": "user", "text": "a"}, {"role": "assistant", "text": None}]
    loop = "{% for m in xs %}{{ loop.index }}{% if loop.first %}F{% elif loop.last %}L{% else %}-{% endif %}{{ m.role|upper }}={{ m['text'] | default('?') }};{% endfor %}"
    assert rendered(loop, xs=iter(turns)) == "1FUSER=a;2LASSISTANT=?;"
    assert rendered("{% set x = 1 + 2 %}{{ x ~ '\\n' ~ (not x == 3) }}{# gone #}{{ none }}") == "3\nfalse"
    assert rendered("{% if 'b' in s and s | length < 4 %}yes{% else %}no{% endif %}", s="abc") == "yes"
    parts = list(template.compile_template("x{% generation %}y{{ z }}{% endgeneration %}")({"z": 5}))
    assert parts == [("x", False), ("y", True), ("5", True)]


def test_templates_are_folded_and_sandboxed():
    folded = template.fold(template.parse("a{{ 'b' ~ (1 + 1) }}{% if true and 2 > 1 %}c{% else %}{{ x }}{% endif %}d"), template.FILTERS)
    assert [n.kind for n in folded.parts] == ["out"] and folded.parts[0].parts[0].value == "ab2cd"
    assert rendered("a{% if true %}c{% endif %}d") == "acd"
    assert rendered("{{ x.__class__ }}|{{ x.upper }}", x="s") == "|"
    for bad in ("{{ f() }}", "{% include 'x' %}", "{% for x in y %}", "{{ a b }}", "{{ 'x }}", "{{ x | nope }}", "{% endif %}", "{{ }}"):
        with pytest.raises(template.TemplateError):
            template.compile_template(bad)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("\\<>|/s[]INST a\n")))
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text
    assert not any(c in out for c in ("<s>", "</s>", "[INST]", "[/INST]", "<|", "|>"))


def test_conversations_of_odd_rows_and_small_parts(spark):
    data = [(1, 0, "user", None), (1, None, None, "first"), (1, 1, "assistant", "x" * 50), (None, 0, "user|>", "q</s>"), (2, 0, "a", "b"), (2, 0, "a", "b")]
    turns = spark.createDataFrame([(*r, "z") for r in data], "conv_id bigint, turn bigint, role string, text string, part string")
    whole = chat.render(turns)
    small = chat.render(turns, part_chars=7)
    assert small.count() > whole.count() == 3
    assert rows(chat.digests(whole)) == rows(chat.digests(small))
    found = {r.conv_id: r for r in chat.digests(small).collect()}
    assert (found[1].n_turns, found[1].loss_chars, found[2].n_turns) == (3, 50, 2) and None in found
    assert chat.digests(chat.render(turns.limit(0))).count() == 0


# --- decontamination --------------------------------------------------------------------


@pytest.fixture(scope="module")
def leaks(spark):
    items = [(k, prose(k, 14)) for k in range(6)] + [(20, "Short item!"), (21, None), (22, "..."), (None, prose(77, 12))]
    clean = [(100 + k, prose(1000 + k, 60), "s") for k in range(5)]
    planted = [
        (1, f"{prose(51, 9)} {items[0][1].upper()}. {prose(52, 9)}", "s"), (2, f"a short  item b {prose(53, 5)} SHORT-item", "s"),
        (3, " ".join(items[1][1].split()[:9]), "s"), (4, f"{items[2][1]}\n{items[3][1]} {items[9][1]}", "s"), (5, None, "s"),
    ]
    return make(spark, clean + planted), spark.createDataFrame([(i, t, "x") for i, t in items], BENCHMARK + ", hits string")


def test_planted_windows_are_found(leaks):
    docs, benchmark = leaks
    found = {r.doc_id: r for r in decontaminate.scan(docs, benchmark, added="_o").select("doc_id", "_o.*").collect()}
    assert {i: (r.n_hit, r["items"]) for i, r in found.items() if r.n_hit} == {1: (14, ["0"]), 2: (4, ["20"]), 4: (40, ["2", "3", "null"])}
    assert decontaminate.clean(docs, benchmark).count() == docs.count() - 3
    cut = {r.doc_id: r.text for r in decontaminate.clean(docs, benchmark, remove="spans").collect()}
    assert cut[1] == f"{prose(51, 9)} . {prose(52, 9)}" and cut[5] is None and cut[4].strip() == ""


def test_blocks_of_items_find_the_same(leaks):
    docs, benchmark = leaks
    one = decontaminate.scan(docs, benchmark, added="_o")
    many = decontaminate.scan(docs, benchmark, added="_o", block_bytes=100)
    assert one.schema["_o"].dataType.simpleString() == many.schema["_o"].dataType.simpleString()
    assert collected(one, "doc_id", "_o") == collected(many, "doc_id", "_o")


def test_decontamination_of_odd_rows(odd_docs, no_docs, leaks):
    _, benchmark = leaks
    assert decontaminate.scan(odd_docs, benchmark, added="_o").where("_o.n_hit > 0").count() == 0
    assert decontaminate.scan(odd_docs, benchmark.limit(0), added="_o").count() == odd_docs.count()
    assert decontaminate.clean(odd_docs, benchmark).columns == odd_docs.columns
    assert decontaminate.scan(no_docs, benchmark).count() == 0


# --- models -----------------------------------------------------------------------------


def test_models_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (4, 1, 0), (7, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    for model, module, column in ((quality_model.train(odd_docs, labels), quality_model, "_m"), (toxicity.train(odd_docs, labels), toxicity, "_m")):
        scores = [r.score for r in module.score(odd_docs, model, added=column).select(f"{column}.score").collect()]
        assert len(scores) == odd_docs.count() and all(0 <= s <= 1 for s in scores)
        assert module.score(no_docs, model).count() == 0
    for module in (quality_model, toxicity):
        empty = module.train(no_docs, labels.limit(0))
        assert {r.s for r in module.score(odd_docs, empty, added="_m").select(F.col("_m.score").alias("s")).collect()} == {0.5}
    assert quality_model.keep(odd_docs, quality_model.train(odd_docs, labels), least=0.0).columns == odd_docs.columns


def test_trees_learn_an_interaction():
    random_ = np.random.default_rng(5)
    x = random_.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    model = quality_model.fit(x[:3000], y[:3000], trees=40)
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.97
    one = model.score(x[:1])
    assert one == pytest.approx(model.score(x[:5])[:1])


def plain_trees(model, row):
    total = model.start
    for feature, threshold, leaf in zip(model.feature.tolist(), model.threshold.tolist(), model.leaf.tolist()):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
        total += leaf[node - len(feature)]
    return 1 / (1 + math.exp(-total))


def best_split(x, slope, curve, edges, ridge=1.0, least=2.0):
    """(gain, feature, threshold) of the best split, tried one by one."""
    g, h, found = slope.sum(), curve.sum(), (1e-9, None, None)
    for f in range(x.shape[1]):
        for e in edges[f]:
            left = x[:, f] <= e
            gl, hl = slope[left].sum(), curve[left].sum()
            if hl >= least and h - hl >= least:
                gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
                if gain > found[0] + 1e-9:
                    found = (gain, f, e)
    return found


def test_trees_equal_plain_ones():
    random_ = np.random.default_rng(8)
    x = np.round(random_.random((400, 5)), 2)
    y = (x[:, 1] + 0.5 * random_.random(400) > 0.8).astype(float)
    model = quality_model.fit(x, y, trees=12, depth=3)
    assert model.score(x) == pytest.approx([plain_trees(model, row) for row in x.tolist()])
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, 65)[1:-1])) for c in x.T]
    margin = np.full(len(y), model.start)
    for t in range(3):  # splits and leaves of the first trees, by trying every edge
        p = 1 / (1 + np.exp(-margin))
        slope, curve, node = p - y, p * (1 - p), np.zeros(len(y), dtype=int)
        for k in range(7):
            here = node == k
            gain, f, e = best_split(x[here], slope[here], curve[here], edges)
            if f is None:
                assert model.threshold[t, k] == np.inf
            else:
                left = x[here][:, model.feature[t, k]] <= model.threshold[t, k]  # as good as the best
                parts = [(slope[here][m].sum(), curve[here][m].sum()) for m in (left, ~left, np.ones(here.sum(), bool))]
                assert sum((-1 if i == 2 else 1) * g * g / (h + 1) for i, (g, h) in enumerate(parts)) == pytest.approx(gain)
            node[here] = 2 * k + 1 + (x[here, model.feature[t, k]] > model.threshold[t, k])
        for leaf in range(8):
            here = node == 7 + leaf
            assert model.leaf[t, leaf] == pytest.approx(-0.15 * slope[here].sum() / (curve[here].sum() + 1))
        margin += model.leaf[t, node - 7]


def test_training_order_does_not_matter(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    hot = docs.unionByName(docs.where("doc_id = 3").withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("_k"))
    for module in (quality_model, toxicity):
        one, two, three = (module.train(d, labels) for d in (docs.coalesce(1), docs.repartition(6), hot.repartition(3)))
        for name, value in vars(one).items():
            if not name.startswith("_"):
                assert np.array_equal(value, getattr(two, name)) and np.array_equal(value, getattr(three, name)), name
    assert common.labelled_sample(hot, labels, "doc_id", "quality", 4, 2, 1000).count() <= labels.select("doc_id").distinct().count()


def plain_ftrl(rows, y, epochs, alpha, beta, l1, l2, seed):
    z, n = {}, {}

    def weight(i):
        a = z.get(i, 0.0)
        rate = (beta + math.sqrt(n.get(i, 0.0))) / alpha
        if i == "bias":
            return -a / rate
        return 0.0 if abs(a) <= l1 else -(a - math.copysign(l1, a)) / (rate + l2)

    random_ = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in random_.permutation(len(rows)):
            own = [*rows[k].tolist(), "bias"]
            w = {i: weight(i) for i in own}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y[k]
            for i in own:
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return weight("bias"), {i: weight(i) for i in z if i != "bias" and weight(i)}


def test_ftrl_equals_a_plain_one():
    random_ = np.random.default_rng(3)
    rows = [np.unique(random_.integers(0, 60, 8)) for _ in range(150)]
    y = np.array([float(5 in r or 9 in r) for r in rows])
    model = toxicity.fit(rows, y, epochs=2, alpha=0.7, beta=1.0, l1=0.8, l2=0.5, seed=4)
    bias, weights = plain_ftrl(rows, y, 2, 0.7, 1.0, 0.8, 0.5, 4)
    assert model.bias == pytest.approx(bias) and dict(zip(model.places.tolist(), model.values.tolist())) == pytest.approx(weights)
    assert 0 < len(weights) < 60


def test_ftrl_is_sparse_and_finds_skip_grams():
    texts = [f"{prose(k, 30)} you {'filler' if k % 3 else 'x'} fool {prose(k + 9000, 5)}" if k % 2 else prose(k, 36) + " you and fool apart from" for k in range(600)]
    places = toxicity.features(pa.array(texts))
    y = np.array([k % 2 for k in range(600)], dtype=float)
    model = toxicity.fit(places[:500], y[:500], l1=3.0)
    assert len(model.places) < 0.02 * (1 << toxicity.BITS)
    assert ((model.score(pa.array(texts[500:])) > 0.5) == y[500:]).mean() > 0.9


# --- near duplicates --------------------------------------------------------------------


def edited(words, random_, edits):
    words = list(words)
    for _ in range(edits):
        words[random_.randrange(len(words))] = f"new{random_.randrange(10**9)}"
    return " ".join(words)


@pytest.mark.parametrize("percent, bands, size", [(85, 32, 6), (80, 40, 5)])
def test_groups_of_graded_copies_lose_no_link(spark, percent, bands, size):
    random_ = random.Random(11)
    data = []
    for group in range(3):
        words = prose(group, 150).split()
        data += [edited(words, random_, random_.choice((0, 0, 1, 1, 2, 3, 4, 6))) for _ in range(110)]
    data += [prose(500 + k, 80) for k in range(40)] + ["tiny text", "Tiny TEXT", "tiny texts", "", None, " "]
    common = prose(999, 60)
    data += [f"{common} {prose(2000 + k, 30)}" for k in range(60)]
    random_.shuffle(data)
    docs = make(spark, [(k, t, "s") for k, t in enumerate(data)])
    found = {r.id: r for r in near_dedup.groups(docs, percent=percent, bands=bands, rows=size).collect()}
    wanted = brute_groups({k: shingles(t) for k, t in enumerate(data)}, percent)
    assert {k: r.component for k, r in found.items()} == wanted
    kept = near_dedup.keep(docs, percent=percent, bands=bands, rows=size)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(wanted.values())) and kept.columns == docs.columns


def test_groups_of_odd_rows(odd_docs, no_docs):
    found = collected(near_dedup.groups(odd_docs), "id", "n", "component", "kept")
    assert len(found) == odd_docs.count()
    assert {r for r in found if r[0] == 9} == {(9, 1, 7, False)} and found.count((7, 1, 7, True)) == 2
    assert all(r[3] for r in found if r[0] != 9)
    assert near_dedup.groups(no_docs).count() == 0 and near_dedup.keep(no_docs).count() == 0
    assert near_dedup.keep(odd_docs).count() == odd_docs.count() - 1


def test_rows_go_by_id_and_set(spark):
    one, two, three, four, five = (prose(600 + k, 40) for k in range(5))
    data = [
        (None, one), (1, one), (None, two),  # a null-id copy, and a clean null-id document
        (5, three), (5, four), (6, four), (2, three), (7, four),  # id 5: one text a copy of 2, the other its group's first
        (8, five), (8, five), (8, five.upper()), (9, None), (9, None), (None, ""),
    ]
    docs = make(spark, [(i, t, "s") for i, t in data])
    told = lambda frame: collected(frame, "doc_id", "text")
    stay = [(1, one), (None, two), (5, four), (2, three), (9, None), (9, None), (None, "")]
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert told(near_dedup.keep(docs)) == sorted([*stay, (8, five), (8, five), (8, five.upper())], key=key)
    once = told(near_dedup.keep(docs.repartition(3), repeats=False))
    assert once in [sorted([*stay, (8, t)], key=key) for t in (five, five.upper())]
    assert once == told(near_dedup.keep(docs.coalesce(1), repeats=False))
    nulls = make(spark, [(None, one, "s"), (None, one, "s"), (None, two, "s"), (None, two, "s")])
    assert told(near_dedup.keep(nulls, repeats=False)) == sorted([(None, one), (None, two)], key=key)
    near = make(spark, [(3, one + " a", "s"), (3, one, "s"), (4, one, "s")])
    assert near_dedup.keep(near, repeats=False).count() == 1 and near_dedup.keep(near).count() == 2


def test_sketches_merge_and_estimate():
    random_ = np.random.default_rng(3)
    a = random_.integers(0, 2**63, 3000).astype(np.uint64)
    b = np.concatenate([a[:2400], random_.integers(0, 2**63, 600).astype(np.uint64)])
    sets = [np.unique(a), np.unique(b), np.unique(np.concatenate([a, b]))]
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    regs = near_dedup.registers(np.concatenate(sets), first, 512)
    assert (near_dedup.merge(regs[0], regs[1]) == regs[2]).all()
    estimate = near_dedup.likely_similarity(regs[:1], regs[1:2], np.array([3000]), np.array([3000]))[0]
    assert abs(estimate - 2400 / 3600) < 0.08


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (3, 2)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- rules ------------------------------------------------------------------------------


def test_rules_of_odd_rows(odd_docs, no_docs):
    judged = rules.assess(odd_docs, carry=["doc_id"])
    assert judged.count() == odd_docs.count()
    assert all(0 <= r.posterior <= 1 for r in judged.select("posterior").collect())
    long = judged.where("n_words > 1000").first()
    assert (long.n_words, long.n_repeat_words, long.n_distinct) == (200_000, 200_000, 977)
    assert rules.assess(no_docs).count() == 0 and rules.keep(no_docs).count() == 0
    assert rules.keep(odd_docs, least=0.0).columns == odd_docs.columns and rules.keep(odd_docs, least=0.0).count() == odd_docs.count()


def test_hard_failures_go_whatever_the_posterior(spark, odd_docs):
    import corpus_pipeline
    from gondola.llm.queries import REGISTRY

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    queried = REGISTRY["op8_weak_rules"](spark, folder).where("kept").collect()
    staged = corpus_pipeline.quality_rules(spark, docs, folder).collect()
    assert sorted(r.doc_id for r in staged) == sorted(r.doc_id for r in queried)
    assert {r.doc_id for r in rules.keep(odd_docs, least=0.0, failed=rules.base_failed()).collect()} == set()


def test_expectation_maximisation_finds_the_accuracies():
    random_ = random.Random(2)
    names, truth = list("abcdef"), {"a": (0.95, 0.9), "b": (0.9, 0.7), "c": (0.98, 0.6), "d": (0.9, 0.9), "e": (0.97, 0.4), "f": (0.6, 0.5)}
    counts = {}
    for _ in range(30_000):
        good = random_.random() < 0.8
        votes = []
        for name in names:
            right = random_.random() < truth[name][0 if good else 1]
            votes.append(0 if random_.random() < 0.3 else (1 if right == good else -1))
        counts[tuple(votes)] = counts.get(tuple(votes), 0) + 1
    found = rules.estimate(sorted(counts.items()), names)
    assert found.good == pytest.approx(0.8, abs=0.02)
    for name in names:
        assert found.accuracy[name] == pytest.approx(truth[name], abs=0.05)


def test_posteriors_equal_plain_ones(spark, odd_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    judged = rules.assess(docs, carry=["doc_id"]).collect()
    names = list(rules.votes())
    judgement = rules.estimate(sorted(Counter(tuple(r[n] for n in names) for r in judged).items()), names)
    for r in judged:
        good, bad = judgement.good, 1 - judgement.good
        for name in names:
            a, b = judgement.accuracy[name]
            if r[name]:
                good *= a if r[name] == 1 else 1 - a
                bad *= 1 - b if r[name] == 1 else b
        assert r.posterior == pytest.approx(good / (good + bad))
    kept = {r.row.doc_id for r in judged if r.posterior >= rules.KEEP}
    assert {r.doc_id for r in rules.keep(docs).collect()} == kept


# --- token counts and language model ----------------------------------------------------


def test_token_counts_of_odd_rows(odd_docs, no_docs):
    pieces = {token_counts.MARK: -1.0, "same": -2.0, "text": -2.0, "w": -3.0, **{str(k): -3.0 for k in range(10)}}
    found = {r.doc_id: r for r in token_counts.count(odd_docs, pieces, added="_o").select("doc_id", "_o.*").collect()}
    assert (found[1].n_words, found[1].n_tokens) == (0, 0) and found[5].n_words == 200_000
    assert token_counts.count(no_docs, pieces).count() == 0


@pytest.mark.parametrize("order", [2, 3])
def test_language_model_of_odd_rows(odd_docs, no_docs, order):
    model = language_model.train(odd_docs, shards=3, order=order)
    found = language_model.score(odd_docs, model, added="_o").select("doc_id", "_o.*").collect()
    assert len(found) == odd_docs.count() and all(r.score < 0 for r in found)
    assert {r.n_tokens for r in found if r.doc_id in (1, 2, 3)} == {1}
    nothing = language_model.train(no_docs, shards=2, order=order)
    assert (nothing.tokens, nothing.vocabulary) == (0, 0)
    assert {r.s for r in language_model.score(odd_docs, nothing, added="_o").select(F.col("_o.score").alias("s")).collect()} == {0.0}
    assert language_model.score(no_docs, model).count() == 0
