"""MinHash near-dedup by SetSketch registers (7).

A document's set is its distinct shingles of `width` words. Documents are linked if their sets' Jaccard
similarity is at least `percent` hundredths; components of links are groups, one document of which is kept.

1. One pass over the texts gives each document the size and a 128-bit fingerprint of its set, and
   `bands` * `rows` SetSketch registers: floor(1 - log_b x) of the smallest of the elements' exponential
   variables x, cut to 16 bits. Sketches of parts merge by the larger register.
2. Documents with equal sets are a class; from here on a class is one row, however many copies it has.
3. Classes that agree in all registers of a band share a bucket. With 32 bands of 6, a pair at 0.85 misses
   every bucket with a chance of 3e-7 (40 bands of 5 at 0.80: 1e-7).
4. Sets are read for the classes that share a bucket at all. A shingle that no other such class has can't be
   common to two sets, so the other ones, the class's core, bound every intersection. Classes whose core is
   too small leave.
5. In each bucket the class with the largest core share is compared with the others on full sets: as many
   pairs as members. Components of these links are found.
6. Pairs of a bucket that step 5 leaves in different components are compared too, unless bounds rule the
   link out: the cores, or what the two are known to lack of, and to have beyond, the bucket's leader. The
   rest is estimated from both sketches by maximum likelihood; what lies 0.15 (five standard errors)
   below the limit goes, all else is confirmed on full sets. Links found here join components.

So no bucket is capped and no bucket emits all of its pairs: members of one component are never paired.

Defined results: null, empty and blank texts have an empty set and are alone; a text of fewer words than
`width` has its whole sequence as its set. A null id is larger than all others; a group without any other
has a null component_id and all of its rows are kept, as are rows that repeat the kept id (`keep` can leave
one of them). Rows are told apart by id and set, so an id may be kept with one text and go with another. Empty
tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gondola.llm import words as W
from gondola.llm.common import by_batch, cut, small
from gondola.llm.components import components

WIDTH = 5
BASE, RATE, LIMIT = 1.001, 20.0, 2**16 - 2
MARGIN = 0.15

_draw = np.random.default_rng(20_240_607)
FACTORS = _draw.integers(0, 2**32, (512, 2), dtype=np.uint64).astype(np.uint32) | np.uint32(1)


def registers(hashes: np.ndarray, first: np.ndarray, count: int) -> np.ndarray:
    """`count` registers for each of the sets `hashes[first[i]:first[i+1]]` (all zero for an empty one)."""
    out = np.zeros((len(first) - 1, count), dtype=np.uint16)
    full = np.flatnonzero(np.diff(first))
    if not len(full):
        return out
    high, low = (hashes >> np.uint64(32)).astype(np.uint32), hashes.astype(np.uint32)
    least = np.empty((len(full), count), dtype=np.uint32)
    for j, (a, b) in enumerate(FACTORS[:count]):
        least[:, j] = np.minimum.reduceat(high * a + low * b, first[full])
    x = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    out[full] = np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, LIMIT + 1)
    return out


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of the union of two sets."""
    return np.maximum(a, b)


def likely_similarity(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, steps: int = 200) -> np.ndarray:
    """The Jaccard similarity under which the registers' larger, smaller and equal counts are likeliest, by pair (row)."""
    more, less = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    u = (size_a / (size_a + size_b))[:, None]
    v = 1 - u
    most = np.minimum(u / v, v / u)
    j = most * np.linspace(0, 1, steps + 1)
    p = lambda x: -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE)
    up, down = p(u - v * j), p(v - u * j)
    log = lambda x: np.log(np.maximum(x, 1e-12))
    value = more * log(up) + less * log(down) + (a.shape[1] - more - less) * log(1 - up - down)
    return j[np.arange(len(j)), value.argmax(1)]


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as bytes."""
    rows = np.ascontiguousarray(rows)
    size = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


def _fingerprints(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Two 64-bit sums for each set: equal sets have equal ones."""
    parts = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(W.mix(hashes ^ np.uint64(salt)), out=sums[1:])
        parts.append(W.mix(np.diff(sums[first]) + np.diff(first).astype(np.uint64)))
    return np.column_stack(parts)


def _sets(column: pa.Array, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct shingles and where each text's begin, run by run."""
    for run in W.runs(column):
        hashes, owner = W.shingles(run, width)
        yield hashes, np.searchsorted(owner, np.arange(run.texts + 1))


def sketch(docs: DataFrame, key: str, text: str, width: int, count: int) -> DataFrame:
    """(id, n, c, registers): size, fingerprint and sketch of each document's set."""

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        n, c, regs = [], [], []
        for hashes, first in _sets(batch.column("text"), width):
            n.append(np.diff(first))
            c.append(_fingerprints(hashes, first))
            regs.append(registers(hashes, first, count))
        return [pa.array(np.concatenate(n).astype(np.int64)), _binary(np.concatenate(c)), _binary(np.concatenate(regs))]

    named = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    return by_batch(named, "s", "n bigint, c binary, registers binary", work).select("id", "s.*")


def buckets(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """(bucket, c): a row for each class and band."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                regs = np.array([np.frombuffer(r.as_py(), np.uint16) for r in batch.column("registers")]).astype(np.uint64)
                code = np.empty((len(regs), bands), dtype=np.uint64)
                for k in range(bands):
                    h = np.full(len(regs), k + 1, dtype=np.uint64)
                    for r in range(rows):
                        h = W.mix(h * np.uint64(65_537) + regs[:, k * rows + r])
                    code[:, k] = h
                at = pa.array(np.repeat(np.arange(len(regs)), bands))
                yield pa.RecordBatch.from_arrays([pa.array(code.ravel().view(np.int64)), batch.column("c").take(at)], ["bucket", "c"])

    return classes.select("c", "registers").mapInArrow(work, "bucket bigint, c binary")


def sets_of(docs: DataFrame, chosen: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(c, n, registers, shingles) of the chosen classes (c, id, n, registers), from one document of each."""

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        c, shingles = [], []
        for hashes, first in _sets(batch.column("text"), width):
            c.append(_fingerprints(hashes, first))
            shingles.extend(hashes[low:high].tobytes() for low, high in zip(first[:-1], first[1:]))
        return [_binary(np.concatenate(c)), pa.array(shingles, pa.binary())]

    named = docs.select(F.col(key).alias("_id"), F.col(text).alias("text"))
    rows = named.join(small(chosen, 50_000), F.col("_id").eqNullSafe(F.col("id"))).drop("_id", "id")
    own = by_batch(rows, "s", "c binary, shingles binary", work).where("s.c = c")  # an id may have other texts too
    return own.select("c", "n", "registers", "s.shingles").dropDuplicates(["c"])


def cores(sets: DataFrame) -> DataFrame:
    """(c, n, core): how many of a class's shingles another class has as well."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c, shingles in zip(batch.column("c"), batch.column("shingles")):
                h, (one, two) = np.frombuffer(shingles.as_py(), np.int64), np.frombuffer(c.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.full(len(h), one)), pa.array(np.full(len(h), two))], ["h", "one", "two"])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = np.column_stack([batch.column("one").to_numpy(), batch.column("two").to_numpy()])
            yield pa.RecordBatch.from_arrays([_binary(both), batch.column("alone")], ["c", "alone"])

    rows = sets.select("c", "shingles").mapInArrow(work, "h bigint, one bigint, two bigint")
    single = rows.groupBy("h").agg(F.count("*").alias("k"), F.min("one").alias("one"), F.min("two").alias("two")).where("k = 1")
    alone = single.groupBy("one", "two").agg(F.count("*").alias("alone")).mapInArrow(name, "c binary, alone bigint")
    return sets.select("c", "n").join(alone, "c", "left").select("c", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("core"))


def confirm(pairs: DataFrame, sets: DataFrame, percent: int, estimate: bool) -> DataFrame:
    """The pairs (a, b) with `common`, the size of their sets' intersection, and `linked`.

    With `estimate`, a pair whose sketches rule the link out is not looked up (common is then null).
    """

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        read = lambda c, kind: [np.frombuffer(x.as_py(), kind) for x in batch.column(c)]
        na, nb = batch.column("a_n").to_numpy(), batch.column("b_n").to_numpy()
        likely = np.ones(len(na), dtype=bool)
        if estimate:
            ra, rb = (np.array(read(c, np.uint16)) for c in ("a_r", "b_r"))
            likely = likely_similarity(ra, rb, na, nb) >= percent / 100 - MARGIN
        common = [len(np.intersect1d(x, y, assume_unique=True)) if k else None for x, y, k in zip(read("a_s", np.uint64), read("b_s", np.uint64), likely)]
        linked = [k is not None and 100 * k >= percent * (x + y - k) for k, x, y in zip(common, na.tolist(), nb.tolist())]
        return [pa.array(common, pa.int64()), pa.array(linked)]

    side = lambda s: sets.select(F.col("c").alias(s), *[F.col(c).alias(f"{s}_{c[0]}") for c in ("n", "registers", "shingles")])
    joined = pairs.join(side("b"), "b").join(side("a"), "a")
    return by_batch(joined, "x", "common bigint, linked boolean", work).select("a", "b", "x.*")


def _possible(common: Column, n: Column, other: Column, percent: int) -> Column:
    return (100 + percent) * common >= percent * (n + other)


def links(docs: DataFrame, classes: DataFrame, key: str, text: str, width: int, percent: int, bands: int, rows: int) -> DataFrame:
    """(node, component) of the classes that are linked to another one."""
    told = buckets(classes, bands, rows)
    shared = small(cut(told.groupBy("bucket").count().where("count > 1").select("bucket")))
    members = cut(told.join(shared, "bucket"))
    chosen = cut(classes.join(members.select("c").distinct(), "c").select("c", "id", "n", "registers"))
    sets = cut(sets_of(docs, chosen, key, text, width))
    live = cut(cores(sets).where(100 * F.col("core") >= percent * F.col("n")))
    members = cut(members.join(live, "c"))

    best = F.min(F.struct((-F.col("core") / F.col("n")).alias("_"), "c", "n", "core"))
    leaders = small(cut(members.groupBy("bucket").agg(best.alias("l"), F.count("*").alias("k")).where("k > 1").drop("k")))
    led = members.join(leaders, "bucket").where("c != l.c")
    star = led.where(_possible(F.least("core", "l.core"), F.col("n"), F.col("l.n"), percent))
    star = cut(confirm(star.select(F.col("l.c").alias("a"), F.col("c").alias("b")).distinct(), sets, percent, False))
    found = components(star.where("linked"))

    known = star.select(F.col("a").alias("_a"), F.col("b").alias("_b"), "common")
    at = led.join(known, (F.col("l.c") == F.col("_a")) & (F.col("c") == F.col("_b")), "left").drop("_a", "_b")
    at = at.join(found, F.col("c") == F.col("node"), "left").drop("node")
    at = cut(at.select(
        "bucket", "c", "n", "core", F.col("l.n").alias("leader"), F.coalesce("component", "c").alias("component"),
        F.coalesce(F.col("l.n") - F.col("common"), F.lit(0)).alias("lacks"),
        F.coalesce(F.col("core") - F.col("common"), F.col("n")).alias("beyond"),
    ))
    several = at.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("bucket")
    at = at.join(several, "bucket", "left_semi")
    x, y = at.alias("x"), at.alias("y")
    common = F.col("leader") - F.greatest("x.lacks", "y.lacks") + F.least("x.beyond", "y.beyond")
    rest = x.join(y.drop("leader"), (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.c") < F.col("y.c")) & (F.col("x.component") != F.col("y.component"))
                  & _possible(F.least(common, "x.core", "y.core"), F.col("x.n"), F.col("y.n"), percent))
    rest = confirm(rest.select(F.col("x.c").alias("a"), F.col("y.c").alias("b")).distinct(), sets, percent, True)
    more = cut(rest.where("linked").select("a", "b"))
    return found if more.isEmpty() else components(star.where("linked").select("a", "b").union(more))


def _grouped(docs: DataFrame, key: str, text: str, width: int, percent: int, bands: int, rows: int) -> DataFrame:
    """(id, n, c, g, component, kept) of every document; g is its group, null if the document is alone."""
    documents = cut(sketch(docs, key, text, width, bands * rows))
    full = documents.where("n > 0").groupBy("c")
    classes = cut(full.agg(F.min("id").alias("id"), F.max("n").alias("n"), F.first("registers").alias("registers"), F.count("*").alias("copies")))
    found = cut(links(docs, classes, key, text, width, percent, bands, rows))
    named = classes.join(found, F.col("c") == F.col("node"), "left").where("node is not null or copies > 1")
    named = cut(named.select("c", "id", F.coalesce("component", "c").alias("g")))
    lowest = named.groupBy("g").agg(F.min("id").alias("component"))
    named = small(cut(named.join(lowest, "g").select("c", "component", "g")))
    told = documents.select("id", "n", "c").join(named, "c", "left")
    component = F.when(F.col("g").isNotNull() & (F.col("n") > 0), F.col("component")).otherwise(F.col("id"))
    return told.select("id", "n", "c", "g", component.alias("component"), F.col("id").eqNullSafe(component).alias("kept"))


def groups(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = 85, bands: int = 32, rows: int = 6,
) -> DataFrame:
    """(id, n, component, kept) of every document: set size, smallest id of its group, whether it is that one."""
    return _grouped(docs, key, text, width, percent, bands, rows).select("id", "n", "component", "kept")


def keep(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = 85, bands: int = 32, rows: int = 6, repeats: bool = True,
) -> DataFrame:
    """The documents' own columns, of one document of each group.

    With `repeats`, all rows that `groups` marks as kept stay: also those that repeat the kept id, and groups of null
    ids. Without, exactly one row of each group stays. An id of one row goes by its id; rows whose id occurs
    again are told apart by their sets.
    """
    told = _grouped(docs, key, text, width, percent, bands, rows)
    known = told.groupBy(F.col("id").alias("_id")).agg(F.count("*").alias("times"), F.count_if(~F.col("kept")).alias("out"))
    known = small(cut(known.where("out > 0" if repeats else "out > 0 or times > 1")))
    whole = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(key).alias("id"), F.col(text).alias("text"))
    marked = whole.join(known, F.col("id").eqNullSafe(F.col("_id")), "left")
    sure = marked.where("times is null").select("row.*")
    several = known.where("times > 1")
    if several.isEmpty():
        return sure

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        c, n = [], []
        for hashes, first in _sets(batch.column("text"), width):
            c.append(_fingerprints(hashes, first))
            n.append(np.diff(first))
        c, n = np.concatenate(c), np.concatenate(n)
        ids = batch.column("id").dictionary_encode().indices.fill_null(-1).to_numpy()
        hashed = batch.column("h").to_numpy()
        order = np.lexsort((hashed, c[:, 1], c[:, 0], ids))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (c[order[1:]] != c[order[:-1]]).any(1) | (ids[order[1:]] != ids[order[:-1]])
        lowest = np.zeros(len(order), dtype=bool)
        lowest[order[new]] = True
        return [_binary(c), pa.array(lowest | (n == 0))]

    # equal rows of a batch leave before any shuffle; h orders the others (maps can't be hashed)
    hashed = F.xxhash64(*[F.col(f"row.{f.name}") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])
    own = by_batch(marked.where("times > 1").select("row", "id", "text", hashed.alias("h")), "s", "c binary, lowest boolean", work)
    own = own.select("row", "id", "h", F.col("s.c").alias("c"), F.col("s.lowest").alias("lowest")).where("true" if repeats else "lowest")
    again = told.where("kept").join(several.select("_id"), F.col("id").eqNullSafe(F.col("_id")), "left_semi")
    again = small(cut(again.select(F.col("id").alias("_id"), F.col("c").alias("_c"), "g").distinct()))
    own = own.join(again, F.col("id").eqNullSafe(F.col("_id")) & (F.col("c") == F.col("_c")))
    if repeats:
        return sure.unionAll(own.select("row.*"))
    own = cut(own.select("row", "h", "c", "g"))
    one = own.where("g is not null").groupBy("g").agg(F.min_by("row", F.struct("c", "h")).alias("row"))
    return sure.unionAll(own.where("g is null").select("row.*")).unionAll(one.select("row.*"))
