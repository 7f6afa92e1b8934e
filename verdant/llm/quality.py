"""Quality rules as weak supervision.

Each rule looks at counts of a text and votes good (1), bad (-1) or abstains
(0). A label model with two classes estimates, by expectation-maximisation, how
often each rule votes good for good texts and bad for bad texts, and a text is
judged by its posterior probability of being good instead of having to pass
every rule. The model is fitted on the histogram of vote patterns over all
documents (at most 3^rules rows, summed by Spark); the posterior is a weighted
sum of votes, so scoring stays a column expression.

Main path: DataFrame functions only. Defined results: a null or empty text has
zero counts and fails the base rules; a text whose rules all abstain gets the
prior; repeated rows are judged each; texts of any length are counted whole; texts with equal
votes have equal posteriors, and one at the threshold is kept; other columns may have any
names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import words, whole_row, written

WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_exclaim", "n_distinct", "n_plain")


@dataclass(frozen=True)
class Rule:
    """Votes bad from ``bad`` on and good up to ``good`` of ``value / per``
    (with ``rising=False`` the other way round); abstains between, and where
    ``per`` is zero."""
    name: str
    value: str
    per: str
    good: float
    bad: float
    rising: bool = True

    def vote(self) -> Column:
        ratio = F.col(self.value) / F.col(self.per)
        bad, good = (ratio >= self.bad, ratio <= self.good) if self.rising else (ratio <= self.bad, ratio >= self.good)
        return (F.when(F.col(self.per) == 0, F.lit(0)).when(bad, F.lit(-1)).when(good, F.lit(1))
                .otherwise(F.lit(0)).cast("tinyint").alias(self.name))


RULES = (
    Rule("symbols_per_word", "n_symbols", "n_words", 0.01, 0.1),
    Rule("symbols_per_char", "n_symbols", "word_chars", 0.002, 0.02),
    Rule("plain_words", "n_plain", "n_words", 0.97, 0.8, rising=False),
    Rule("repeat_words", "n_repeat_words", "n_words", 0.05, 0.2),
    Rule("dup_lines", "n_dup_lines", "n_lines", 0.1, 0.4),
    Rule("upper_case", "n_upper", "word_chars", 0.2, 0.5),
    Rule("exclamations", "n_exclaim", "n_words", 0.05, 0.3),
    Rule("distinct_words", "n_distinct", "n_words", 0.3, 0.1, rising=False),
    Rule("word_length", "word_chars", "n_words", 10.0, 15.0),
)


def _without(text: Column, others: str) -> Column:
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def text_counts(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] | None = None) -> DataFrame:
    """``(row, counts)``: ``row`` has the columns ``carry`` of ``docs`` (default
    all), ``counts`` is a struct of the longs in ``COUNTS``."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    kept = docs if carry is None else docs.select(*[f"`{c}`" for c in carry])
    df = docs.select(whole_row(kept), words(text).alias("w"), F.split(text, "\n").alias("raw_lines"),
                     text.alias("t"))
    size = F.size("w")
    starts = F.when(size >= WINDOW, F.sequence(F.lit(0), size - WINDOW)).otherwise(F.array().cast("array<int>"))
    w = F.col("w")
    df = df.select(
        "*", F.filter("raw_lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.transform(starts, lambda i: F.xxhash64(*[w[i + k] for k in range(WINDOW)])).alias("windows"))
    # Texts with two windows of one hash are looked at exactly: windows in order
    # of their words, then the places of those equal to a neighbour.
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    df = df.withColumn("ordered", F.when(twice, F.sort_array(F.transform(
        starts, lambda i: F.struct(F.concat_ws(" ", *[w[i + k] for k in range(WINDOW)]).alias("g"), i.alias("i"))))))
    o, last = F.col("ordered"), F.size("ordered") - 1
    same = lambda a, b: o[a]["g"] == o[b]["g"]
    df = df.withColumn("places", F.when(twice, F.sort_array(F.transform(
        F.filter(F.sequence(F.lit(0), last), lambda j: ((j > 0) & same(F.greatest(j - 1, F.lit(0)), j))
                 | ((j < last) & same(j, F.least(j + 1, last)))), lambda j: o[j]["i"]))))
    p = F.col("places")
    covered = F.when(twice & (F.size(p) > 0), F.aggregate(
        F.sequence(F.lit(0), F.size(p) - 1), F.lit(0),
        lambda a, k: a + F.when(k + 1 < F.size(p), F.least(F.lit(WINDOW), p[F.least(k + 1, F.size(p) - 1)] - p[k]))
        .otherwise(WINDOW))).otherwise(0)
    joined = F.array_join("w", "")
    return df.select("row", F.struct(
        F.size("w").cast("long").alias("n_words"),
        F.length(joined).cast("long").alias("word_chars"),
        _without(F.col("t"), r"[^#*$%&|<>]+").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        _without(F.col("t"), r"[^\p{Lu}]+").alias("n_upper"),
        _without(F.col("t"), r"[^!]+").alias("n_exclaim"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        F.size(F.filter("w", lambda x: x.rlike(r"^[\p{L}\p{N}'’\-]+[.,;:!?]*$"))).cast("long").alias("n_plain"),
    ).alias("counts"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass(frozen=True)
class LabelModel:
    prior: float
    good_given_good: tuple[float, ...]
    bad_given_bad: tuple[float, ...]

    def log_odds(self, rules=RULES) -> Column:
        out = F.lit(math.log(self.prior / (1 - self.prior)))
        for rule, a, b in zip(rules, self.good_given_good, self.bad_given_bad, strict=True):
            out = out + F.when(F.col(rule.name) == 1, math.log(a / (1 - b))).when(
                F.col(rule.name) == -1, math.log((1 - a) / b)).otherwise(0.0)
        return out


def fit_label_model(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100) -> LabelModel:
    """Expectation-maximisation over ``(votes, number of documents)``.

    Abstentions carry no evidence. It starts from "bad if any rule says bad" and
    adds one document's worth of counts to every rate, so no rate is 0 or 1.
    Patterns are taken in sorted order: reruns agree to the last bit."""
    patterns = sorted(patterns)
    n_rules = len(patterns[0][0]) if patterns else 0
    good = [0.1 if -1 in v else 0.95 for v, _ in patterns]
    prior, gg, bb = 0.9, [0.9] * n_rules, [0.6] * n_rules
    for _ in range(rounds):
        total = sum(n for _, n in patterns)
        weight = sum(g * n for g, (_, n) in zip(good, patterns, strict=True))
        prior = (weight + 1) / (total + 2)
        for r in range(n_rules):
            gp = sum(g * n for g, (v, n) in zip(good, patterns, strict=True) if v[r] == 1)
            gn = sum(g * n for g, (v, n) in zip(good, patterns, strict=True) if v[r] == -1)
            bp = sum((1 - g) * n for g, (v, n) in zip(good, patterns, strict=True) if v[r] == 1)
            bn = sum((1 - g) * n for g, (v, n) in zip(good, patterns, strict=True) if v[r] == -1)
            gg[r], bb[r] = (gp + 1) / (gp + gn + 2), (bn + 1) / (bp + bn + 2)
        before, good = good, []
        for v, _ in patterns:
            odds = math.log(prior / (1 - prior))
            for r, x in enumerate(v):
                odds += math.log(gg[r] / (1 - bb[r])) if x == 1 else math.log((1 - gg[r]) / bb[r]) if x == -1 else 0.0
            good.append(1 / (1 + math.exp(-max(-700.0, min(700.0, odds)))))
        if max((abs(a - b) for a, b in zip(before, good, strict=True)), default=0.0) < 1e-9:
            break
    return LabelModel(prior, tuple(gg), tuple(bb))


def judged(docs: DataFrame, *, text_col: str = "text", rules=RULES, threshold: float = 0.5,
           carry: tuple[str, ...] | None = None) -> DataFrame:
    """``(row, counts..., votes..., base_failed, quality, kept)`` for every row
    of ``docs``; ``row`` holds its columns (``carry``: only these). Counts are written once: the model
    is fitted on the votes of the documents that pass the base rules, all of them."""
    counted = written(text_counts(docs, text_col, carry), "quality-counts")
    voted = counted.select("row", "counts.*").withColumn("base_failed", base_failed())
    voted = voted.select("*", *[r.vote() for r in rules])
    names = [r.name for r in rules]
    patterns = [(tuple(int(row[c]) for c in names), row["n"]) for row in
                voted.where(~F.col("base_failed")).groupBy(*names).agg(F.count("*").alias("n")).collect()]
    model = fit_label_model(patterns) if patterns else LabelModel(0.5, (0.5,) * len(rules), (0.5,) * len(rules))
    quality = 1 / (1 + F.exp(-model.log_odds(rules)))
    return (voted.withColumn("quality", quality)
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that pass, with the same columns."""
    return judged(docs, **options).where("kept").select("row.*")
