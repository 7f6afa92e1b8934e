"""Toxicity by weak supervision.

1. Lexicons come from at most ``LEXICON_ROWS`` labelled rows (chosen by a hash of
   their text): words, and beginnings of five and six letters, that are several
   times as frequent among toxic texts as among others.
2. Voters look at a text. Eight go by the lexicons: six lexicon voters (two for each
   kind of entry), the share of words that hit any entry, and the number of different
   entries hit. Five go by patterns: exclamations, runs of marks, masked letters, threats
   against a second person, and words in capitals. Each votes toxic, clean, or abstains;
   all patterns but the first only vote toxic or abstain.
3. A generative model with two classes explains the votes of all documents of
   the learning fold, labelled or not. The voters' rates are estimated by
   expectation-maximisation; their correlations by a tree: each voter depends on
   the class and on the one voter it shares most information with. Labelled rows
   keep their label while it is fitted. It is fitted on the histogram of vote patterns, which has at
   most 3^9 * 2^4 patterns for each of the labels 0, 1 and none.
4. A logistic regression on what the voters see (the hits of each lexicon as
   shares of the words, their summed evidence, how many entries and words were
   hit, the patterns) is trained on the posterior labels of the whole learning fold and scores every text;
   for labelled rows the posterior counts the given label as one more, accurate voter. The texts are read once for votes and features.

Defined results: a null or empty text has all features zero; a row with a null id is held out; repeated rows count
as often as they occur; texts of any length are looked at whole; texts with equal features have equal scores; other columns are
left out, whatever their names; an empty table gives an empty result; if no row of the learning fold is labelled toxic, or none
is labelled clean, every score is the share of toxic labels (0 without labels).
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import written
from verdant.llm.hyperlang import in_fold

LEXICON_ROWS = 20_000    # labelled rows at most from which lexicons are drawn
LEXICON = 900            # entries at most
LEAST_DOCS, LEAST_SHARE, LEAST_RATIO = 4, 0.01, 6.0   # of an entry: toxic documents, their share, how many times as frequent
BEGINNINGS = (5, 6)
TOXIC, CLEAN, ABSTAIN = 1, 0, 2
N_VOTERS = 13
LABEL_ACCURACY = 0.98    # of the given labels, as voters
# Patterns that speak for toxicity.
MARKS = re.compile(r"[!?]{3}")
MASKED = re.compile(r"(?<![^\W_])[^\W\d_][*@#$%]{1,8}[^\W\d_]")
THREATS = re.compile(r"\b(?:kill|hurt|beat|destroy|hate|smash)\W{1,3}(?:you|your|u)\b|\b(?:you|u)\W{1,3}(?:will|should|must|deserve to)\W{1,3}(?:die|suffer|pay|burn)\b")
CAPITALS = re.compile(r"\b[^\W\d_]{3,}\b")
_TOKEN = re.compile(r"[^\W_]+")


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def features(token_array: Column) -> Column:
    """Words and their beginnings: ``w:idiots``, ``5:idiot``, ``6:idiots``."""
    def begin(n):
        return F.transform(F.filter(token_array, lambda x: F.length(x) >= n), lambda x: F.concat(F.lit(f"{n}:"), F.substring(x, 1, n)))
    return F.concat(F.transform(token_array, lambda x: F.concat(F.lit("w:"), x)), *[begin(n) for n in BEGINNINGS])


def _at_most(rows: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows at most, chosen by a hash of their text; all of them if there are no more."""
    n = rows.count()
    part = min(1.0, most / max(n, 1))
    return rows if part == 1.0 else rows.where(F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1_000_000)) < int(part * 1_000_000))


def learn_lexicon(labelled: DataFrame, entries: int) -> dict[str, tuple[int, float]]:
    """Entry -> (voter, log ratio). Frequent and telling entries first, dealt in
    turn to the two voters of their kind."""
    sample = written(labelled.select("text", "toxic"), "toxic-sample")
    size = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = size.get(1, 0), size.get(0, 0)
    seen = sample.select("toxic", F.explode(F.array_distinct(features(tokens(F.col("text"))))).alias("f"))
    df = seen.groupBy("f").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    ratio = ((F.col("bad") + 0.5) / (bad + 1)) / ((F.col("good") + 0.5) / (good + 1))
    best = (df.where((F.col("bad") >= max(LEAST_DOCS, LEAST_SHARE * bad)) & (ratio >= LEAST_RATIO))
            .withColumn("weight", F.log(ratio)).orderBy(F.desc(F.col("bad") * F.col("weight")), "f").limit(entries).collect())
    turn, out = {"w": 0, "5": 0, "6": 0}, {}
    for row in best:
        kind = row["f"][0]
        out[row["f"]] = 2 * "w56".index(kind) + turn[kind] % 2, row["weight"]
        turn[kind] += 1
    return out


class _Entries(dict):
    """Lexicon entries of a word, remembered for frequent words."""

    def __init__(self, lexicon: dict[str, tuple[int, float]]):
        self.lexicon = lexicon

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) > 500_000:
            self.clear()
        found = self[word] = tuple(e for e in ("w:" + word, *(f"{n}:{word[:n]}" for n in BEGINNINGS if len(word) >= n))
                                   if e in self.lexicon)
        return found


def look_at(text: str | None, entries: _Entries) -> tuple[str, list[float]]:
    """The votes as a string of digits, and the features of the classifier."""
    text = text or ""
    lower = text.lower()
    words = _TOKEN.findall(lower)
    hits, any_hit, evidence, different = [0] * 6, 0, 0.0, set()
    for found in filter(None, map(entries.__getitem__, words)):
        any_hit += 1
        different.update(found)
        evidence += max(entries.lexicon[e][1] for e in found)
        for e in found:
            hits[entries.lexicon[e][0]] += 1
    n = max(len(words), 1)
    shouts = text.count("!")
    votes = [TOXIC if h and h >= 0.008 * n else CLEAN if not h and n >= 20 else ABSTAIN for h in hits]
    votes.append(TOXIC if any_hit >= 0.012 * n and any_hit > 1 else CLEAN if any_hit <= 0.006 * n else ABSTAIN)
    votes.append(TOXIC if len(different) >= 6 else CLEAN if len(different) <= 1 else ABSTAIN)
    votes.append(TOXIC if shouts > 0.3 * n else CLEAN if not shouts else ABSTAIN)
    marks, masked, threats = (sum(1 for _ in p.finditer(t)) for p, t in ((MARKS, text), (MASKED, text), (THREATS, lower)))
    loud = sum(x.isupper() for x in CAPITALS.findall(text)) if text != lower else 0
    votes += [TOXIC if found else ABSTAIN for found in (marks, masked, threats, loud > 0.3 * n)]
    percent = lambda x: min(100.0 * x / n, 3.0)
    seen = [*map(percent, hits), percent(any_hit), min(100.0 * evidence / n, 10.0), math.log1p(len(different)), math.log1p(any_hit),
            math.log1p(evidence), min(shouts / n, 1.0), percent(marks), percent(masked), percent(threats), min(loud / n, 1.0)]
    return "".join(map(str, votes)), seen


def _look_batches(lexicon: dict[str, tuple[int, float]]):
    def run(batches):
        entries = _Entries(lexicon)
        for batch in batches:
            seen = [look_at(t, entries) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([v for v, _ in seen], pa.string()),
                 pa.array([x for _, x in seen], pa.list_(pa.float64()))], names=["doc_id", "held_out", "votes", "x"])
    return run


class LabelModel:
    """P(class) and P(vote | parent's vote, class) of a tree of voters."""

    def __init__(self, patterns: np.ndarray, weights: np.ndarray, labels: np.ndarray, rounds: int = 40):
        """``patterns``: one row of votes each; ``labels``: 0, 1 or -1 (none)."""
        known = labels >= 0
        self.parent = [-1] * patterns.shape[1]
        if {0, 1} <= set(labels[known].tolist()):       # the labelled rows alone first
            toxic, own = np.where(known, labels, 0.5), np.where(known, weights, 0.0)
            self.parent = self._tree(patterns, own, toxic)
            self._estimate(patterns, own, toxic)
            toxic = np.where(known, labels, self.posterior(patterns))
        else:
            more = (patterns == TOXIC).sum(1) > (patterns == CLEAN).sum(1)
            toxic = np.where(known, labels, np.where(more, 0.9, 0.1))
        for step in range(rounds):
            if step == rounds // 2:
                self.parent = self._tree(patterns, weights, toxic)
            self._estimate(patterns, weights, toxic)
            toxic = np.where(known, labels, self.posterior(patterns))

    @staticmethod
    def _joint(patterns, weights, toxic, i, j):
        """Weighted counts [class, vote i, vote j], smoothed."""
        out = np.full((2, 3, 3), 0.5)
        for c, p in ((0, 1 - toxic), (1, toxic)):
            np.add.at(out[c], (patterns[:, i], patterns[:, j]), weights * p)
        return out

    def _tree(self, patterns, weights, toxic) -> list[int]:
        """Parents in the tree of the largest information shared within the classes."""
        n = patterns.shape[1]
        shared = np.zeros((n, n))
        for i in range(n):
            for j in range(i):
                t = self._joint(patterns, weights, toxic, i, j)
                p = t / t.sum()
                each = p.sum(2, keepdims=True) * p.sum(1, keepdims=True) / p.sum((1, 2), keepdims=True)
                shared[i, j] = shared[j, i] = (p * np.log(p / each)).sum()
        parent, inside = [-1] * n, [0]
        while len(inside) < n:
            gain, i, j = max((shared[i, j], -i, j) for i in range(n) if i not in inside for j in inside)
            parent[-i] = j
            inside.append(-i)
        return parent

    def _estimate(self, patterns, weights, toxic):
        total = np.array([(weights * (1 - toxic)).sum() + 1, (weights * toxic).sum() + 1])
        self.log_prior = np.log(total / total.sum())
        self.log_vote = []
        for i, j in enumerate(self.parent):
            t = self._joint(patterns, weights, toxic, i, j if j >= 0 else i)
            t = np.repeat(t.sum(2, keepdims=True), 3, axis=2) if j < 0 else t
            self.log_vote.append(np.log(t / t.sum(1, keepdims=True)))

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability that a text with these votes is toxic."""
        score = np.repeat(self.log_prior[None, :], len(patterns), axis=0)
        for i, j in enumerate(self.parent):
            for c in (0, 1):
                score[:, c] += self.log_vote[i][c, patterns[:, i], patterns[:, j if j >= 0 else i]]
        return 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -50, 50)))


def posterior_labels(voted: DataFrame) -> DataFrame:
    """``(votes, label, toxic)`` for every pattern and label of rows ``(votes, label)``."""
    rows = sorted((r["votes"], r["label"], r["n"]) for r in voted.groupBy("votes", "label").agg(F.count("*").alias("n")).collect())
    patterns = np.array([[int(x) for x in v] for v, _, _ in rows]).reshape(len(rows), N_VOTERS)
    labels = np.array([y for _, y, _ in rows])
    model = LabelModel(patterns, np.array([n for _, _, n in rows], dtype=float), labels)
    # A given label is one more voter, right with probability LABEL_ACCURACY.
    p, right = model.posterior(patterns), np.where(labels == 1, LABEL_ACCURACY, 1 - LABEL_ACCURACY)
    toxic = np.where(labels >= 0, p * right / (p * right + (1 - p) * (1 - right)), p)
    return voted.sparkSession.createDataFrame([(v, int(y), float(p)) for (v, y, _), p in zip(rows, toxic, strict=True)],
                                              "votes string, label int, toxic double")


def score_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", parts: int = 4, part: int = 2, threshold: float = 0.3) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs``.
    ``labels`` has rows ``(doc_id, toxic)``; only those outside the held-out fold are read."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                       in_fold(F.col(f"`{id_col}`"), parts, part).alias("held_out"))
    seen = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label")) \
        .where(F.col("label").isin(0, 1) & ~in_fold(F.col("doc_id"), parts, part)) \
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["n"] for r in seen.groupBy("label").agg(F.count("*").alias("n")).collect()}
    labelled = rows.where(~F.col("held_out")).select("doc_id", "text").join(seen, "doc_id").withColumnRenamed("label", "toxic")
    held = {0, 1} <= {r["toxic"] for r in labelled.select("toxic").distinct().collect()}
    if not held:
        share = counts.get(1, 0) / max(sum(counts.values()), 1)
        out = rows.select("doc_id", "held_out", F.lit(float(share)).alias("score"))
        return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    lexicon = learn_lexicon(_at_most(labelled, LEXICON_ROWS), LEXICON)
    kind = rows.schema["doc_id"].dataType.simpleString()
    looked = written(rows.mapInArrow(_look_batches(lexicon), f"doc_id {kind}, held_out boolean, votes string, x array<double>")
                     .join(seen, "doc_id", "left").withColumn("label", F.coalesce("label", F.lit(-1)))
                     .withColumn("x", array_to_vector("x")), "toxic-looked")
    learning = looked.where("not held_out")
    weak = F.broadcast(posterior_labels(learning.select("votes", "label")))     # one row a pattern
    soft = F.explode(F.array(F.struct(F.lit(1.0).alias("y"), F.col("toxic").alias("w")),
                             F.struct(F.lit(0.0).alias("y"), (1 - F.col("toxic")).alias("w"))))
    train = learning.join(weak, ["votes", "label"]).select("x", soft.alias("s")).select("x", "s.y", "s.w").where("w > 0.001")
    model = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", regParam=1e-4, maxIter=100).fit(train)
    out = model.transform(looked).select("doc_id", "held_out", F.element_at(vector_to_array("probability"), 2).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
