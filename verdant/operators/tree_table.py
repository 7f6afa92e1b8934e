"""A decision tree as a table of nodes.

Nodes are rows ``(id, feature, threshold, left, right, prediction)``; a leaf has
no children (-1). The table can be stored, read, edited or written by hand, and
scores rows without the model: a row goes left while its feature is at most the
threshold, which is one expression over the nodes as one broadcast row.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.session import scratch_path

NODES = "id int, feature int, threshold double, left int, right int, prediction double"
MAX_NODES = 1 << 20


def node_table(spark, model) -> DataFrame:
    """The nodes of a fitted tree with continuous features, from its saved form."""
    path = scratch_path(spark, "tree")
    model.save(path)
    split = F.col("split")
    known = F.when(split["numCategories"] >= 0, F.raise_error(F.lit("the tree splits a categorical feature")).cast("double"))
    return spark.read.parquet(f"{path}/data").select(
        "id", split["featureIndex"].alias("feature"),
        F.coalesce(known, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"), "prediction")


def cut_predictions(spark, model, depths) -> dict:
    """``{depth: predictions}``: for every leaf, in the order of the model's leaf column, what the tree predicts there when
    it is grown to ``depth`` only: the prediction of the leaf's ancestor at that depth, or its own if it lies higher."""
    nodes = node_table(spark, model).select("id", "left", "right", "prediction").toArrow()      # a model
    ids, left, right, prediction = (nodes.column(c).to_numpy() for c in ("id", "left", "right", "prediction"))
    order = np.argsort(ids)                       # ids are given from the root down, left before right, as leaves are
    left, right, prediction = left[order], right[order], prediction[order]
    out = {d: prediction.copy() for d in depths}
    level, at = np.array([0]), 0
    while len(level := level[left[level] >= 0]):
        for d, cut in out.items():
            if at >= d:
                cut[left[level]] = cut[right[level]] = cut[level]
        level, at = np.concatenate([left[level], right[level]]), at + 1
    return {d: cut[left < 0] for d, cut in out.items()}


def tree_depth(nodes: list) -> int:
    """Edges on the longest way down; fails on a table that is no tree from node 0 with ids 0, 1, 2..."""
    at = {n["id"]: n for n in nodes}
    if sorted(at) != list(range(len(nodes))):
        raise ValueError("node ids must be 0, 1, 2, ... without repeats")
    depth, level, seen = -1, [0] if at else [], 0
    while level:
        depth, seen = depth + 1, seen + len(level)
        if seen > len(nodes):
            raise ValueError("a node has two parents")
        level = [c for i in level if at[i]["left"] >= 0 for c in (at[i]["left"], at[i]["right"])]
    if seen < len(nodes):
        raise ValueError("a node has no parent")
    return max(depth, 0)


def score_nodes(df: DataFrame, nodes: DataFrame, features: Column | str = "features") -> DataFrame:
    """``df`` with ``leaf`` (node id) and ``prediction`` by the node table. ``features``: an array of doubles, or the name
    of a vector column."""
    rows = nodes.limit(MAX_NODES + 1).collect()             # a model: at most 2^depth leaves
    if len(rows) > MAX_NODES:
        raise ValueError(f"more than {MAX_NODES} nodes")
    depth, spark, names = tree_depth(rows), df.sparkSession, df.columns
    ordered = sorted(([r["id"], r["feature"], r["threshold"], r["left"], r["right"], r["prediction"]] for r in rows))
    one = spark.createDataFrame([([tuple(r) for r in ordered],)], f"_nodes array<struct<{NODES.replace(' ', ':').replace(',:', ',')}>>")
    x = vector_to_array(F.col(features), "float64") if isinstance(features, str) else features
    n = F.col("_nodes")
    down = lambda at, _: F.when(n[at]["left"] < 0, at).when(F.col("_x")[n[at]["feature"]] <= n[at]["threshold"], n[at]["left"]).otherwise(n[at]["right"])
    leaf = F.aggregate(F.sequence(F.lit(0), F.lit(depth)), F.lit(0), down)
    out = df.withColumn("_x", x).crossJoin(F.broadcast(one)).withColumn("leaf", leaf).withColumn("prediction", n[F.col("leaf")]["prediction"])
    return out.select(*[F.col(f"`{c}`") for c in names if c not in ("leaf", "prediction")], "leaf", "prediction")
