"""Joins with a large table under keys of which a few hold much of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# A key is hot from this share of all rows on; a hot key is dealt over so many groups of rows.
HOT, SALTS = 0.01, 64
TRACKED = 10_000


def hot_keys(rows: DataFrame, key: str, share: float = HOT) -> list:
    """The keys with at least about `share` of all rows, from one mergeable count sketch: at most
    1 / share of them (two times as many are asked for). Null keys join with nothing and are not counted."""
    known = rows.filter(F.col(key).isNotNull())
    told = known.agg(F.call_function("approx_top_k", F.col(key), F.lit(int(2 / share)), F.lit(TRACKED)).alias("k"), F.count("*").alias("n")).first()
    return [item["item"] for item in told.k or () if item["count"] >= share * told.n]


def join(rows: DataFrame, side: DataFrame, key: str, how: str = "inner", share: float = HOT, salts: int = SALTS) -> DataFrame:
    """rows joined with side on key by a shuffle in which no hot key is one task's.

    Rows of a hot key are dealt over `salts` groups by their place in their task, and the side's
    rows of these keys, and of no others, are repeated for each group. So each row meets
    each of its partners exactly once, as in the plain join. `how` is inner or left_semi.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError(how)
    hot = hot_keys(rows, key, share)
    if not hot:
        return rows.join(side, key, how)
    is_hot = F.col(key).isin(hot)
    dealt = rows.withColumn("_sal", F.when(is_hot, F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(0).cast("int"))
    groups = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(side.withColumn("_sal", F.explode(groups)), [key, "_sal"], how).drop("_sal")
