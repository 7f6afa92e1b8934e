"""Gradient descent for many parameter settings at once.

A search over step size, mini-batch share, regularisation and iterations needs
one pass over the training set for each iteration, not for each setting:
settings that differ in their iterations only are one trajectory, and one
pass computes the gradients of all trajectories. Weights go to the tasks with
the function that adds up Arrow batches of rows, gradients come back as sums by
feature index; rows keep their partitions, and nothing but these sums is shuffled.

The rule is that of Spark's RDD solvers: step size ``step / sqrt(t)``, gradients
averaged over the batch, squared L2 penalty, an end when a step is shorter than
``TOLERANCE`` times the weights (or times 1). A mini-batch is chosen by the hash
of row key and iteration, so it does not depend on partitions, retries or
cluster size, and a smaller batch is part of a larger one.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.functions.vectors import entries_of
from verdant.session import scratch_path

TOLERANCE = 0.001
TOGETHER = 24                    # trajectories of one aggregate; more are run one group after the other
_BATCH_CELLS = 1 << 31
_LITERAL_CHARS = 1 << 16         # of weights that stand in the expression itself


@dataclass
class TrainingTable:
    """Rows ``(y, row_hash, entries)`` in the shared folder, read by every iteration."""
    rows: DataFrame
    width: int


def training_table(df: DataFrame, label: str = "label", features: str = "features", key: str | None = None) -> TrainingTable:
    """Writes the training rows once, at their own partitions. A label other than 0 or 1 fails.

    ``key`` names a column that tells rows apart (default: ``url`` if there is one, else the row's content); rows of
    equal key are in the same mini-batches."""
    spark = df.sparkSession
    key = key or ("url" if "url" in df.columns else None)
    y = F.col(label).cast("double")
    checked = F.when(y.isin(0.0, 1.0), y).otherwise(F.raise_error(
        F.concat(F.lit("label must be 0 or 1, got "), F.coalesce(F.col(label).cast("string"), F.lit("NULL")))).cast("double"))
    row_hash = F.xxhash64(key) if key else F.xxhash64(F.to_json(F.struct(features, label)))
    path = scratch_path(spark, "training-rows")
    df.select(checked.alias("y"), row_hash.alias("row_hash"), F.col(features).alias("v")).write.parquet(path)
    # Read as the parts that a vector is stored in.
    stored = spark.read.schema("y double, row_hash bigint, v struct<type:tinyint,size:int,indices:array<int>,values:array<double>>").parquet(path)
    width = stored.agg(F.max(F.coalesce(F.col("v.size"), F.size("v.values")))).first()[0] or 0
    return TrainingTable(stored.select("y", "row_hash", entries_of("v").alias("entries")), int(width))


def in_batch(share: float, iteration: int) -> str:
    """SQL: whether a row is in the mini-batch of an iteration."""
    if share >= 1.0:
        return "true"
    return f"pmod(xxhash64(row_hash, {iteration}), {_BATCH_CELLS}L) < {int(share * _BATCH_CELLS)}L"


_MARGIN = "aggregate(zip_with(entries.indices, entries.values, (i, x) -> x * w[i]), 0D, (a, x) -> a + x)"
# Class 1; the logistic cut is asked of the probability, as the scorer does.
_CUTS = {"logistic": "1D / (1D + exp(-m)) > 0.5D", "svm": "m > 0D"}


def _margins(data: TrainingTable, weights: list[list[float]], result: str):
    """``(frame, SQL)`` of an array with ``result`` for the margin m of every weight vector. A few weights stand in the
    expression; many are one broadcast row."""
    text, frame = json.dumps(weights), data.rows
    if len(text) <= _LITERAL_CHARS:
        source = f"from_json('{text}', 'array<array<double>>')"
    else:
        source = "all_weights"
        frame = frame.crossJoin(F.broadcast(frame.sparkSession.createDataFrame([(weights,)], "all_weights array<array<double>>")))
    return frame, f"transform(transform({source}, w -> {_MARGIN}), m -> {result})"


def _gradients(data: TrainingTable, kind: str, weights: np.ndarray, shares: list[float], iteration: int):
    """``(gradient sums, rows in the batch)`` of each weight vector, from one pass.

    A task adds up its rows, Arrow batch by Arrow batch, and hands on one row a feature it saw; these meet by feature."""
    distinct = sorted(set(shares))
    batch = [f"b{k}" for k in range(len(distinct))]
    own, points = [batch[distinct.index(s)] for s in shares], range(len(shares))
    inside = data.rows.where("entries.values IS NOT NULL").selectExpr(
        "y", "entries.indices AS i", "entries.values AS x", *[f"{in_batch(s, iteration)} AS {b}" for s, b in zip(distinct, batch, strict=True)])
    width, logistic = weights.shape[1], kind == "logistic"

    def added(batches):
        sums, count, seen = np.zeros((len(own), width)), np.zeros(len(own)), np.zeros(width, dtype=bool)
        for r in batches:
            y = r.column("y").to_numpy(zero_copy_only=False)
            at = np.repeat(np.arange(len(y)), r.column("i").value_lengths().to_numpy(zero_copy_only=False))
            i, x = (r.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("i", "x"))
            found, place = np.unique(i, return_inverse=True)
            seen[found] = True
            for p, b in enumerate(own):
                m = np.bincount(at, weights=x * weights[p][i], minlength=len(y))
                with np.errstate(over="ignore"):
                    slope = 1 / (1 + np.exp(-m)) - y if logistic else np.where((2 * y - 1) * m < 1, 1 - 2 * y, 0.0)
                drawn = r.column(b).to_numpy(zero_copy_only=False).astype(bool)
                sums[p, found] += np.bincount(place, weights=x * np.where(drawn, slope, 0.0)[at], minlength=len(found))
                count[p] += drawn.sum()
        if count.any():
            kept = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(kept, -1).astype("int32")),      # index -1 counts rows
                                              *[pa.array(np.append(g[kept], n)) for g, n in zip(sums, count, strict=True)]],
                                             names=["i", *[f"g{p}" for p in range(len(own))]])

    parts = inside.where(" OR ".join(batch)).mapInArrow(added, "i int, " + ", ".join(f"g{p} double" for p in points))
    gradient, totals = np.zeros_like(weights), np.zeros(len(shares))
    for row in parts.groupBy("i").agg(*[F.sum(f"g{p}").alias(f"g{p}") for p in points]).collect():     # one row a feature
        if row["i"] < 0:
            totals[:] = row[1:]
        else:
            gradient[:, row["i"]] = row[1:]
    return gradient, totals


@dataclass
class BatchFit:
    weights: list[float]
    train_ms: float               # from the start of the search to the setting's last iteration
    iterations: int


def fit_batch(data: TrainingTable, kind: str, settings: list[dict]) -> list[BatchFit]:
    """Weights for each setting ``{iterations, step, mini_batch, reg}`` (share 1 and no penalty if left out), from as
    many passes as the longest has iterations. ``kind``: ``logistic`` or ``svm``."""
    keys = [(float(s["step"]), float(s.get("mini_batch", 1.0)), float(s.get("reg", 0.0))) for s in settings]
    distinct = list(dict.fromkeys(keys))
    found: dict[int, BatchFit] = {}
    for at in range(0, len(distinct), TOGETHER):
        group = distinct[at:at + TOGETHER]
        members = [[i for i, k in enumerate(keys) if k == g] for g in group]
        weights, ended = np.zeros((len(group), data.width)), [False] * len(group)
        last = [max(int(settings[i]["iterations"]) for i in m) for m in members]
        began = time.perf_counter()
        for t in range(max(last, default=0) + 1):
            live = [p for p in range(len(group)) if not ended[p] and t <= last[p]]
            if t and live:
                sums, count = _gradients(data, kind, weights[live], [group[p][1] for p in live], t)
                for p, g, n in zip(live, sums, count, strict=True):
                    if not n:                        # an empty batch changes nothing
                        continue
                    step, _, reg = group[p]
                    rate = step / np.sqrt(t)
                    new = weights[p] * (1 - rate * reg) - rate * g / n
                    ended[p] = t > 1 and np.linalg.norm(new - weights[p]) < TOLERANCE * max(np.linalg.norm(new), 1.0)
                    weights[p] = new
            for p, m in enumerate(members):
                for i in m:
                    if i not in found and (ended[p] or int(settings[i]["iterations"]) <= t):
                        found[i] = BatchFit(weights[p].tolist(), (time.perf_counter() - began) * 1000, t)
            if all(ended[p] or t >= last[p] for p in range(len(group))):
                break
    return [found[i] for i in range(len(settings))]


def score_counts(data: TrainingTable, kind: str, weights: list[list[float]]) -> list[dict]:
    """``{tp, fp, fn, tn}`` of the hard predictions of every weight vector, from one pass."""
    if not weights:
        return []
    width = max([data.width, *map(len, weights)])
    frame, cuts = _margins(data, [w + [0.0] * (width - len(w)) for w in weights], _CUTS[kind])
    by_point = frame.selectExpr("y", f"posexplode({cuts}) AS (p, yes)").groupBy("p").agg(
        *[F.expr(f"count_if(y = {y} AND {'' if yes else 'NOT '}yes) AS {name}") for name, y, yes in
          (("tp", 1, True), ("fp", 0, True), ("fn", 1, False), ("tn", 0, False))])
    out = [{"tp": 0, "fp": 0, "fn": 0, "tn": 0} for _ in weights]
    for row in by_point.collect():                  # one row a setting
        out[row["p"]] = {k: int(row[k]) for k in ("tp", "fp", "fn", "tn")}
    return out


def auc_of_counts(c: dict) -> float | None:
    """AUC of hard predictions as one exact ratio, as ``metrics.auc_hard``."""
    p, n = float(c["tp"] + c["fn"]), float(c["fp"] + c["tn"])
    return (float(c["tp"]) * n + float(c["tn"]) * p) / (2.0 * p * n) if p and n else None
