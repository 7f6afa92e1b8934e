"""Helpers shared by the corpus operators: the word rule, written scratch
tables, and connected components as Spark jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.operators.broadcast import broadcast_if_small
from verdant.session import scratch_path

# A word is a maximal run of bytes other than space and \t..\r.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Array of the words of a text (null text: null)."""
    return F.array_remove(F.split(text, GAP), "")


def n_words(text: Column) -> Column:
    """Number of words of a text as a long (null text: 0)."""
    return F.when(text.isNull(), F.lit(0)).otherwise(F.size(words(text))).cast("long")


_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def written(df: DataFrame, prefix: str, arrow_bytes: int | None = None) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back: the lineage
    is cut, and a lost executor costs only the reading of a file. With
    ``arrow_bytes`` the Arrow batches of this write are no larger, whatever the
    session's setting, so that long texts don't add up in a Python worker."""
    spark = df.sparkSession
    path = scratch_path(spark, prefix)
    before = spark.conf.get(_ARROW_BYTES, None)
    if arrow_bytes:
        spark.conf.set(_ARROW_BYTES, str(arrow_bytes))
    try:
        df.write.parquet(path)
    finally:
        if arrow_bytes:
            spark.conf.set(_ARROW_BYTES, before) if before else spark.conf.unset(_ARROW_BYTES)
    return spark.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame, name: str = "row") -> Column:
    """All columns as one struct, so that working columns cannot clash."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def dealt_join(many: DataFrame, one: DataFrame, key: str, spread: tuple[str, ...], per_part: int = 1000) -> DataFrame:
    """Inner join of ``many`` with ``one``, which has one row a key. A key with more than ``per_part`` rows is dealt out:
    its rows go by the hash of their columns ``spread``, and its row of ``one`` is replicated once for every
    ``per_part`` of them."""
    hot = written(many.groupBy(key).agg(F.ceil(F.count("*") / per_part).cast("int").alias("_parts")).where("_parts > 1"), "hot-keys")
    parts = F.coalesce("_parts", F.lit(1))
    left = many.join(broadcast_if_small(hot), key, "left").withColumn("_part", F.pmod(F.xxhash64(*spread), parts).cast("int")).drop("_parts")
    right = one.join(broadcast_if_small(hot), key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return left.join(right, [key, "_part"]).drop("_part")


def _min_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph given as rows ``(u, v)``.

    Alternates large-star and small-star steps until the edge set no longer
    changes; then every node hangs on the smallest node of its component. Every
    step is a partial aggregation and a join, edges never multiply, and each
    round is written to the shared scratch folder. Returns ``(node,
    component)`` for the nodes that have an edge to another node."""
    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "cc")
    state = None
    for _ in range(max_rounds):
        # Large star: every larger neighbour of u moves to the smallest of u's neighbourhood.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_min_neighbour(both), "u").where("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        # Small star: u and its smaller neighbours move to the smallest of them.
        small = (large.join(_min_neighbour(large), "u")
                 .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        edges = written(small, "cc")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
