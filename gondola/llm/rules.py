"""Quality rules (8), with DataFrame functions only: weak supervision instead of all-must-pass.

Each rule reads a few statistics of the whole text and votes good (1), bad (-1) or abstains (0). Votes are
counted by pattern (at most 3**rules rows, whatever the input), and expectation-maximisation over those
counts estimates the share of good documents and each rule's accuracy on good and on bad ones. A
document's posterior is the sum of its votes' log odds, computed as a column.

A rule has two accuracies, as junk comes in kinds: most rules vote good on the kinds they do not know, so
few are right on most bad documents. Accuracies stay in [`LOWEST`, `HIGHEST`] and their sum above 1 + `EDGE`: a
vote for bad is always likelier on a bad document, so "good" stays what the rules mean by it.

Repeated passages are found inside a row: window hashes and positions share a long (as many low bits as the
text has words), so one sort of longs brings equal windows together; neighbours are then compared word by
word. A chance agreement of the remaining hash bits is thereby never taken for a repeat.

Defined results: null and blank texts have no words, only abstentions, and the prior as posterior; an empty
table estimates nothing and keeps the start values. Repeated rows count as often as they occur.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from gondola.llm.common import WORD, cut

LOWEST, HIGHEST = 0.02, 0.998
EDGE = 0.05
START = (0.98, 0.3)
KEEP = 0.5
WINDOW = 5

BLANK = r"[\x20\x09-\x0D]+"
NOT_SYMBOL = r"[^#*$%&|<>]+"
NOT_CAPITAL = r"[^\p{Lu}]+"
NOT_LETTER = r"[^\p{L}\p{Nd}]+"
NOT_SHOUT = r"[^!|]+"
ENDS = r"\p{L}[.?!:;](?=[\x20\x09-\x0D]|$)"

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_letters", "n_capitals", "n_shouts", "n_ends")


def repeat_words(frame: DataFrame, words: str, width: int = WINDOW) -> DataFrame:
    """Adds n_repeat_words: words inside windows that the array `words` holds twice or more."""
    n = F.size(words)
    bits = F.length(F.bin(n.cast("bigint")))
    hashed = frame.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w))).withColumn("_b", bits)
    at = lambda a, i: F.get(a, i.cast("int"))
    window = lambda h, i: F.xxhash64(h, *[at(F.col("_h"), i + k) for k in range(1, width)])
    coded = F.transform(
        F.slice("_h", 1, F.greatest(n - (width - 1), F.lit(0))),
        lambda h, i: F.call_function("shiftleft", window(h, i), F.col("_b")).bitwiseOR(i.cast("bigint")),
    )
    sorted_ = hashed.withColumn("_s", F.sort_array(coded)).withColumn("_m", (F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_b")) - 1))
    high = lambda v: F.call_function("shiftright", v, F.col("_b"))
    place = lambda v: v.bitwiseAND(F.col("_m"))
    same_words = lambda p, q: F.slice(words, (p + 1).cast("int"), width) == F.slice(words, (q + 1).cast("int"), width)

    def repeated(v: Column, i: Column) -> Column:
        before, after = at(F.col("_s"), F.greatest(i - 1, F.lit(0))), at(F.col("_s"), i + 1)
        up = (i > 0) & (high(v) == high(before)) & same_words(place(v), place(before))
        down = after.isNotNull() & (high(v) == high(after)) & same_words(place(v), place(after))
        return up | F.coalesce(down, F.lit(False))

    places = F.sort_array(F.transform(F.filter("_s", repeated), place))
    start = F.struct(F.lit(-width).cast("bigint").alias("last"), F.lit(0).cast("bigint").alias("n"))
    covered = F.aggregate(
        "_p", start,
        lambda a, p: F.struct(p.alias("last"), (a.n + F.least(F.lit(width).cast("bigint"), p - a.last)).alias("n")),
        lambda a: a.n,
    )
    return sorted_.withColumn("_p", places).withColumn("n_repeat_words", covered).drop("_h", "_b", "_s", "_m", "_p")


def statistics(frame: DataFrame, text: str = "text") -> DataFrame:
    """Adds the columns of `STATISTICS` (all long); a null text counts as an empty one."""
    frame = frame.withColumn("_t", F.coalesce(F.col(text), F.lit(""))).withColumn("_w", F.regexp_extract_all("_t", F.lit(WORD), 0))
    left = lambda pattern: F.length(F.regexp_replace("_t", pattern, "")).cast("bigint")
    lines = F.filter(F.split("_t", "\n"), lambda line: F.length(F.regexp_replace(line, BLANK, "")) > 0)
    frame = frame.withColumn("_l", lines).withColumns({
        "n_words": F.size("_w").cast("bigint"),
        "word_chars": left(BLANK),
        "n_symbols": left(NOT_SYMBOL),
        "n_lines": F.size("_l").cast("bigint"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint"),
        "n_distinct": F.size(F.array_distinct("_w")).cast("bigint"),
        "n_letters": left(NOT_LETTER),
        "n_capitals": left(NOT_CAPITAL),
        "n_shouts": left(NOT_SHOUT),
        "n_ends": F.regexp_count("_t", F.lit(ENDS)).cast("bigint"),
    })
    told = repeat_words(frame, "_w").drop("_t", "_w", "_l")
    # through a generator: a filter above would otherwise be pushed below and compute each statistic many times
    others = [c for c in told.columns if c not in STATISTICS]
    return told.select(*others, F.inline_outer(F.array(F.struct(*STATISTICS))))


def _vote(bad: Column, good: Column) -> Column:
    vote = F.when(bad, -1).when(good, 1).otherwise(0)
    return F.when(F.col("n_words") > 0, vote).otherwise(0).cast("int")


def votes() -> dict[str, Column]:
    """The rules, over the columns of `STATISTICS`. Whole-number comparisons, so no division by zero."""
    n, c = F.col("n_words"), F.col
    return {
        "length": _vote(n < 10, n >= 50),
        "word_length": _vote((c("word_chars") < 2 * n) | (c("word_chars") > 14 * n), (c("word_chars") >= 3 * n) & (c("word_chars") <= 10 * n)),
        "symbols": _vote(10 * c("n_symbols") > n, 100 * c("n_symbols") <= n),
        "duplicate_lines": _vote(10 * c("n_dup_lines") > 3 * c("n_lines"), (c("n_dup_lines") == 0) & (c("n_lines") > 1)),
        "repeats": _vote(100 * c("n_repeat_words") > 20 * n, 100 * c("n_repeat_words") <= 5 * n),
        "variety": _vote(5 * c("n_distinct") < n, 5 * c("n_distinct") >= 2 * n),
        "capitals": _vote(10 * c("n_capitals") > 3 * c("n_letters"), 10 * c("n_capitals") <= c("n_letters")),
        "shouting": _vote(10 * c("n_shouts") > n, 100 * c("n_shouts") <= n),
        "letters": _vote(20 * c("n_letters") < 17 * c("word_chars"), 20 * c("n_letters") >= 18 * c("word_chars")),
        "sentences": _vote(c("n_ends") * 100 < n, c("n_ends") * 40 >= n),
    }


@dataclass
class Judgement:
    """Share of good documents, and by rule its accuracies on (good, bad) documents."""

    good: float
    accuracy: dict[str, tuple[float, float]]

    def log_odds(self) -> Column:
        """Of being good, from the rules' vote columns."""
        total = F.lit(math.log(self.good / (1 - self.good)))
        for rule, (on_good, on_bad) in self.accuracy.items():
            yes, no = math.log(on_good / (1 - on_bad)), math.log((1 - on_good) / on_bad)
            total = total + F.when(F.col(rule) == 1, yes).when(F.col(rule) == -1, no).otherwise(0.0)
        return total


def _held(on_good: float, on_bad: float) -> tuple[float, float]:
    on_good = max(LOWEST + EDGE, min(HIGHEST, on_good))
    return on_good, max(1 + EDGE - on_good, LOWEST, min(HIGHEST, on_bad))


def estimate(patterns: list[tuple[tuple[int, ...], int]], rules: list[str], rounds: int = 50) -> Judgement:
    """Expectation-maximisation over (votes, number of documents) pairs.

    An abstention says nothing about a document. Each accuracy has the weight of two made-up
    documents added, so rare rules stay near their start.
    """
    judgement = Judgement(0.8, {rule: START for rule in rules})
    total = sum(count for _, count in patterns)
    for _ in range(rounds if total else 0):
        right, voted = {r: [2 * START[0], 2 * START[1]] for r in rules}, {r: [2.0, 2.0] for r in rules}
        good = 0.0
        for pattern, count in patterns:
            odds = math.log(judgement.good / (1 - judgement.good))
            for rule, vote in zip(rules, pattern):
                a, b = judgement.accuracy[rule]
                odds += (math.log(a / (1 - b)) if vote == 1 else math.log((1 - a) / b)) if vote else 0.0
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
            good += count * p
            for rule, vote in zip(rules, pattern):
                if vote:
                    voted[rule][0] += count * p
                    voted[rule][1] += count * (1 - p)
                    right[rule][0 if vote == 1 else 1] += count * (p if vote == 1 else 1 - p)
        accuracy = {r: _held(right[r][0] / voted[r][0], right[r][1] / voted[r][1]) for r in rules}
        judgement = Judgement(max(0.01, min(0.99, (good + 8) / (total + 10))), accuracy)
    return judgement


def learn(told: DataFrame) -> Judgement:
    """From a frame with the vote columns."""
    rules = list(votes())
    counted = told.groupBy(*rules).count().collect()
    return estimate(sorted((tuple(r[rule] for rule in rules), r["count"]) for r in counted), rules)


def judge(frame: DataFrame, judgement: Judgement) -> Column:
    """The posterior probability of being good."""
    return 1 / (1 + F.exp(-judgement.log_odds()))


def assess(docs: DataFrame, *, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns `carry` in a struct `row`, the statistics, the votes and the posterior, over one reading of the texts."""
    carried = F.struct(*[F.col(c) for c in carry]).alias("row") if carry else F.struct(F.lit(True).alias("_")).alias("row")
    told = statistics(docs.select(carried, F.col(text).alias("_text")), "_text").drop("_text").withColumns(votes())
    told = cut(told)
    return told.withColumn("posterior", judge(told, learn(told)))


def base_failed() -> Column:
    """Under ten words, or over a fifth of them in repeated windows; over the columns of `STATISTICS`."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def keep(docs: DataFrame, *, text: str = "text", least: float = KEEP, failed: Column | None = None) -> DataFrame:
    """The documents' own columns, of those whose posterior is at least `least` and that have not `failed`.

    Reads the texts twice, once to learn and once to judge, as keeping them meanwhile would cost more disk.
    """
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    told = lambda *more: statistics(docs.select(*more, F.col(text).alias("_text")), "_text").withColumns(votes())
    judgement = learn(told())
    judged = told(row)
    good = judge(judged, judgement) >= least
    return judged.where(good if failed is None else good & ~failed).select("row.*")
