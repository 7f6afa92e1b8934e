"""Parquet tables of the data set, plus Spark-derived stand-ins for the
inputs the classic jobs expect (text lines, labelled documents, pages)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# A scan with at least this many splits is a large input and already parallel;
# spreading it would reshuffle it for nothing.
SPREAD_LIMIT = 256


def spread(df: DataFrame, *keys: str, target: int | None = None,
           like: DataFrame | None = None) -> DataFrame:
    """Give CPU-heavy per-row work (tokenising, regexes, checksums) at least
    ``target`` tasks (default: the cluster's parallelism, at most
    ``SPREAD_LIMIT``).

    A scan is as parallel as its files/row groups. Large inputs already have
    many, and then this is a no-op (no shuffle); a small input in a few big
    row groups would otherwise put all text work on a few cores, so those rows
    (after column pruning) are spread. Only inputs with fewer splits than the
    target are spread, and the target is capped, so the shuffle this adds is
    bounded by a small input. With ``keys`` (a unique row key) rows are hash
    partitioned: deterministic on retry without the local sort a round-robin
    spread needs, and it already clusters later per-key aggregations.

    The partition count is read from ``like`` (default ``df``), which must be
    a plain scan/projection, so the check is planning-only: on a plan with an
    exchange, adaptive execution would run its stages just to report it."""
    target = target or min(df.sparkSession.sparkContext.defaultParallelism, SPREAD_LIMIT)
    if (like if like is not None else df).rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, *keys) if keys else df.repartition(target)


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents.text`` as text lines ``(doc_id, line_no, value)``.

    Same line rule as ``spark.read.text``: split on ``\\n``/``\\r\\n``/``\\r``
    and no empty last line for a trailing terminator.
    """
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    body = F.regexp_replace("text", r"(\r\n|\r|\n)$", "")
    return docs.select("doc_id", F.posexplode(F.split(body, r"\r\n|\r|\n")).alias("line_no", "value"))
