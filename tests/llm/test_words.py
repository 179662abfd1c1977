"""Words and windows from Arrow buffers against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from gondola.llm import words as W

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = st.lists(st.none() | st.text(st.sampled_from("aAbZ09 \n\t\x0b\x0c\r.-éñ中\u00a0\u2003|"), max_size=30), max_size=12)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_are_those_of_the_pattern(texts, chunk):
    column = pa.array(["skip", *texts], pa.string()).slice(1)
    before, W.CHUNK = W.CHUNK, chunk
    try:
        for parting, pattern in ((W.BLANKS, BLANK), (W.NOT_ALPHANUMERIC, LETTERS)):
            found, runs = [], list(W.runs(column, parting))
            for run in runs:
                assert run.at == len(found)
                found += [[run.word(k).decode() for k in range(run.first[i], run.first[i + 1])] for i in range(run.texts)]
            assert found == [pattern.findall((t or "").translate(LOWER)) for t in texts]
    finally:
        W.CHUNK = before


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=9), max_size=6), st.integers(1, 5))
def test_equal_shingles_and_only_they_have_equal_hashes(texts, width):
    seen = {}
    for run in W.runs(pa.array([" ".join(t) for t in texts], pa.string())):
        hashes, owner = W.shingles(run, width)
        for i in range(run.texts):
            words = texts[run.at + i]
            wanted = {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()
            own = hashes[owner == i].tolist()
            assert len(own) == len(set(own)) == len(wanted)
            key = frozenset(wanted)
            assert seen.setdefault(key, own) == own
    flat = {tuple(v): k for k, v in seen.items()}
    assert len(flat) == len(seen)


def test_long_windows_hash_alike_anywhere():
    values = np.arange(3_000, dtype=np.uint64) % np.uint64(7)
    hashes = W.window_hashes(values, 10)
    assert len(set(hashes.tolist())) == 7 and (hashes[:-7] == hashes[7:]).all()
