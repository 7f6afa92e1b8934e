"""Binary classification metrics as DataFrame aggregations.

Inputs are DataFrames of ``(score, label)`` (label 0/1). Curves need counts
cumulated in descending score order; a bare ``Window.orderBy`` would pull
every distinct score into one task, so ``score_curve`` runs an exact
distributed prefix sum instead:

1. partial + final aggregate by score (a hot score costs one row per task),
   written to the scratch folder, so the input is read once;
2. score buckets from approximate quantiles of the distinct scores
   (``Bucketizer``: binary search);
3. cumulative window *per bucket* (one bucket ~ one task's worth of rows);
4. per-bucket totals (one row per bucket, a bounded table) turned into
   offsets and broadcast back.

Ratios are formed from exact integer counts with one division, so they do
not depend on summation order.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.session import written


def _d(c: Column) -> Column:
    return c.cast("double")


def score_curve(df: DataFrame, score: str = "score", label: str = "label",
                buckets: int | None = None) -> DataFrame:
    """Per distinct score, descending: ``score, pos, neg, tp, fp, P, N`` where
    ``tp``/``fp`` count positives/negatives with a score >= this one. A row
    without a score fails: leaving it out would change every count."""
    spark = df.sparkSession
    if buckets is None:
        buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    lab = F.col(label).cast("long")
    # The input (often a model's scoring of a large set) is read once: its
    # per-score aggregate (<= one row per distinct score) is written and both
    # the bucket bounds and the curve are computed from it.
    kind = df.schema[score].dataType
    known = F.coalesce(F.col(score), F.raise_error(F.lit("a row has no score")).cast(kind))
    g = written(df.groupBy(known.alias("score"))
                .agg(F.sum(lab).alias("pos"), F.sum(F.lit(1) - lab).alias("neg")), "scores")

    bounds = []
    if buckets > 1:
        # Quantiles of the distinct scores: equal numbers of aggregated rows
        # per bucket, i.e. balanced window tasks.
        probs = [i / buckets for i in range(1, buckets)]
        row = g.agg(F.percentile_approx(_d(F.col("score")), probs, max(1000, 4 * buckets)).alias("q")).first()
        bounds = sorted({b for b in (row["q"] or []) if b is not None})
    splits = [float("-inf"), *bounds, float("inf")]
    nb = len(splits) - 1
    if nb == 1:
        g = g.withColumn("bucket", F.lit(0))
    else:
        # Non-nullable bucket: no inferred null filters, so both uses of
        # ``within`` below plan identically and share one shuffle.
        g = (Bucketizer(splits=splits, inputCol="score_d", outputCol="bucket", handleInvalid="keep")
             .transform(g.withColumn("score_d", _d(F.col("score"))))
             .withColumn("bucket", F.coalesce((F.lit(nb - 1) - F.col("bucket")).cast("int"), F.lit(-1)))
             .drop("score_d"))

    w = Window.partitionBy("bucket").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    within = g.select("bucket", "score", "pos", "neg",
                      F.sum("pos").over(w).alias("cpos"), F.sum("neg").over(w).alias("cneg"))

    # One row per bucket (a bounded table), from the same windowed rows: the
    # input is scanned and aggregated once; the window over it is tiny.
    tot = within.groupBy("bucket").agg(F.sum("pos").alias("bpos"), F.sum("neg").alias("bneg"))
    wb = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    wall = Window.partitionBy(F.lit(0))
    offs = tot.select(
        "bucket",
        F.coalesce(F.sum("bpos").over(wb), F.lit(0)).alias("opos"),
        F.coalesce(F.sum("bneg").over(wb), F.lit(0)).alias("oneg"),
        F.sum("bpos").over(wall).alias("P"),
        F.sum("bneg").over(wall).alias("N"))
    j = within.join(F.broadcast(offs), "bucket")     # at most one row per bucket
    return j.select("score", "pos", "neg",
                    (F.col("opos") + F.col("cpos")).alias("tp"),
                    (F.col("oneg") + F.col("cneg")).alias("fp"),
                    "P", "N")


def roc_curve(curve: DataFrame) -> DataFrame:
    """E5: exact ROC ``(threshold, fpr, tpr)``, with the (0,0) and (1,1) ends
    (threshold NULL there)."""
    spark = curve.sparkSession
    pts = curve.select(F.col("score").cast("double").alias("threshold"),
                       (_d(F.col("fp")) / _d(F.col("N"))).alias("fpr"),
                       (_d(F.col("tp")) / _d(F.col("P"))).alias("tpr"))
    ends = spark.createDataFrame([(None, 0.0, 0.0), (None, 1.0, 1.0)], "threshold double, fpr double, tpr double")
    return pts.unionByName(ends)


def auc(curve: DataFrame) -> DataFrame:
    """Area under the ROC from scores (ties as trapezoids), exactly:
    sum(neg_i * (2*tp_i - pos_i)) / (2*P*N) in integer/decimal arithmetic."""
    num = F.sum((F.col("neg").cast("decimal(38,0)") *
                 (F.lit(2) * F.col("tp") - F.col("pos")).cast("decimal(38,0)")))
    agg = curve.agg(num.alias("num"), F.first("P").alias("P"), F.first("N").alias("N"))
    return agg.select(F.when((F.col("P") > 0) & (F.col("N") > 0),
                             _d(F.col("num")) / (F.lit(2.0) * _d(F.col("P")) * _d(F.col("N"))))
                      .alias("auc"))


def f_measure_by_threshold(curve: DataFrame, beta: float = 1.0) -> DataFrame:
    """``(threshold, f_measure, precision, recall)`` per distinct score.
    F_beta = (1+b^2)tp / ((1+b^2)tp + b^2 fn + fp), with fn = P - tp."""
    b2 = beta * beta
    tp, fp, P = _d(F.col("tp")), _d(F.col("fp")), _d(F.col("P"))
    if beta == 1.0:
        f = (F.lit(2.0) * tp) / (P + tp + fp)
    else:
        f = ((1 + b2) * tp) / ((1 + b2) * tp + b2 * (P - tp) + fp)
    return curve.select(F.col("score").cast("double").alias("threshold"),
                        f.alias("f_measure"),
                        (tp / (tp + fp)).alias("precision"),
                        F.when(P > 0, tp / P).alias("recall"))


def best_threshold(fm: DataFrame) -> DataFrame:
    """The threshold with the largest F; on ties the highest threshold
    (the first in descending-threshold order). Distributed top-1."""
    return fm.orderBy(F.desc("f_measure"), F.desc("threshold")).limit(1) \
        .select("threshold", "f_measure")


def apply_threshold(df: DataFrame, threshold: Column | float, score: str = "score") -> DataFrame:
    """``prediction = score >= threshold``."""
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return df.withColumn("prediction", (F.col(score) >= t).cast("double"))


def confusion(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One aggregation pass: tp, fp, tn, fn as longs."""
    p, y = F.col(prediction), F.col(label)

    def cnt(c):
        return F.sum(c.cast("long"))
    return df.agg(cnt((p == 1) & (y == 1)).alias("tp"), cnt((p == 1) & (y == 0)).alias("fp"),
                  cnt((p == 0) & (y == 0)).alias("tn"), cnt((p == 0) & (y == 1)).alias("fn"))


def auc_hard(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """AUC of hard 0/1 predictions = (1 + TPR - FPR)/2, as one exact ratio
    (TP*N + TN*P) / (2*P*N)."""
    c = confusion(df, prediction, label)
    P = F.col("tp") + F.col("fn")
    N = F.col("fp") + F.col("tn")
    num = _d(F.col("tp")) * _d(N) + _d(F.col("tn")) * _d(P)
    return c.select(F.when((P > 0) & (N > 0), num / (F.lit(2.0) * _d(P) * _d(N))).alias("auc"))


def accuracy(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Share of rows with prediction == label."""
    ok = F.sum((F.col(prediction) == F.col(label)).cast("long"))
    return df.agg((_d(ok) / _d(F.count(F.lit(1)))).alias("accuracy"))


def success_rate(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """E4 (+P3): success count, total and rate in one aggregation."""
    ok = F.sum((F.col(prediction) == F.col(label)).cast("long"))
    return (df.agg(ok.alias("success"), F.count(F.lit(1)).alias("total"))
            .withColumn("rate", _d(F.col("success")) / _d(F.col("total"))))


def prediction_report(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Every row tagged ``correct``/``wrong``."""
    return df.withColumn("result", F.when(F.col(prediction) == F.col(label), F.lit("correct"))
                         .otherwise(F.lit("wrong")))


# Class descriptions of the page classifier.
CLASS_DESCRIPTIONS = {0: "ephemeral", 1: "evergreen"}


def describe_prediction(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Class number -> text."""
    p = F.col(prediction)
    return df.withColumn("description",
                         F.when(p == 0, F.lit(CLASS_DESCRIPTIONS[0]))
                         .when(p == 1, F.lit(CLASS_DESCRIPTIONS[1])))


def grid_auc_hard(df: DataFrame, thresholds: list[float], score: str = "score",
                  label: str = "label") -> DataFrame:
    """AUC of ``score >= t`` for every ``t`` in a grid, in ONE scan: the grid
    becomes conditional aggregates (no join with the grid), then the single
    result row is unpivoted. Output ``(grid_index, threshold, auc)``."""
    y = F.col(label).cast("long")
    aggs = [F.sum(y).alias("P"), F.sum(F.lit(1) - y).alias("N")]
    for i, t in enumerate(thresholds):
        hit = (F.col(score) >= F.lit(float(t))).cast("long")
        aggs += [F.sum(hit * y).alias(f"tp{i}"), F.sum(hit * (F.lit(1) - y)).alias(f"fp{i}")]
    row = df.agg(*aggs)
    P, N = _d(F.col("P")), _d(F.col("N"))
    items = []
    for i, t in enumerate(thresholds):
        tp, fp = _d(F.col(f"tp{i}")), _d(F.col(f"fp{i}"))
        a = F.when((P > 0) & (N > 0), (tp * N + (N - fp) * P) / (F.lit(2.0) * P * N))
        items.append(F.struct(F.lit(i).alias("grid_index"), F.lit(float(t)).alias("threshold"),
                              a.alias("auc")))
    return row.select(F.inline(F.array(*items)))


def best_of_grid(grid: DataFrame, metric: str = "auc", order_col: str = "grid_index") -> DataFrame:
    """G2 tie rule: the best metric; on ties the LAST in grid order wins."""
    return grid.orderBy(F.desc(metric), F.desc(order_col)).limit(1)
