"""Splitting and combining labelled sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.functions.features import hash_bucket

SPLIT_NAMES = ("train", "validation", "test")
HASH_BUCKETS = 10000


def split_label(key, weights: Sequence[float] = (0.8, 0.1, 0.1),
                names: Sequence[str] = SPLIT_NAMES, buckets: int = HASH_BUCKETS) -> Column:
    """Name of the part a row falls in, from a stable hash of ``key``.

    Weights are normalised; cut points are cumulative bucket counts."""
    total = float(sum(weights))
    b = hash_bucket(key, buckets)
    cuts, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        cuts.append(int(round(acc * buckets)))
    expr = F.lit(names[-1])
    for cut, name in reversed(list(zip(cuts, names[:-1]))):
        expr = F.when(b < cut, F.lit(name)).otherwise(expr)
    return expr


def hash_split(df: DataFrame, key: str, weights: Sequence[float] = (0.8, 0.1, 0.1),
               names: Sequence[str] = SPLIT_NAMES) -> list[DataFrame]:
    """R1 (repeatable form): one DataFrame per part; a pure projection +
    filter of the same plan, no shuffle and no dependence on partitioning."""
    tagged = df.withColumn("_split", split_label(key, weights, names))
    return [tagged.where(F.col("_split") == n).drop("_split") for n in names]


def random_split(df: DataFrame, weights: Sequence[float], seed: int | None = None) -> list[DataFrame]:
    """Spark's sampler split (seeded when ``seed`` is given)."""
    return df.randomSplit(list(weights), seed)


def split_counts(tagged: DataFrame, split_col: str = "split") -> DataFrame:
    """A1: rows per part in one aggregation pass."""
    return tagged.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))


def union_labelled(positive: DataFrame, negative: DataFrame, label_col: str = "label") -> DataFrame:
    """P10 + U1: tag each side with a constant label; union keeps duplicates."""
    return (positive.withColumn(label_col, F.lit(1.0))
            .unionByName(negative.withColumn(label_col, F.lit(0.0))))
