"""Binary learners behind one interface (M1-M7).

``fit(train_df) -> Fitted``; ``Fitted.transform(df)`` adds ``score`` (raw
margin or probability of class 1) and ``prediction`` (0.0/1.0).

* SGD logistic regression and SGD linear SVM keep the step size and
  mini-batch knobs, which only the RDD-based ``pyspark.mllib`` API has. Their
  rows are written as labelled-point text by SQL expressions to the shared
  checkpoint folder, once per fit or grid search, and parsed back by the JVM
  loader. Python sees a single row (the solver wrapper's type check). Their
  scoring is a SQL expression over the fitted weights.
* L-BFGS / OWL-QN logistic regression, linear SVC and decision trees use the
  DataFrame ``pyspark.ml`` estimators directly.

No learner changes the partitioning of its input: a training set that comes in
n partitions is trained in n tasks.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml.classification import (DecisionTreeClassifier, LinearSVC, LogisticRegression)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.functions.vectors import active_entries, linear_margin, sigmoid, sparse_margin
from verdant.operators.batched_sgd import BatchFit, TrainingTable, fit_batch, training_table
from verdant.operators.broadcast import MAX_BROADCAST_BYTES
from verdant.operators.features import continuous
from verdant.session import scratch_path, written

# Default parameters of the classic page jobs.
LR_SGD_DEFAULTS = {"iterations": 5, "step": 50.0, "mini_batch": 0.5}
SVM_SGD_DEFAULTS = {"iterations": 25, "step": 50.0, "reg": 1.0}
TREE_DEFAULTS = {"impurity": "entropy", "max_depth": 10, "max_bins": 10}


@dataclass
class Fitted:
    name: str
    params: dict
    model: Any
    train_ms: float
    scorer: Any = field(repr=False)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.scorer(df)


def _timed(fn):
    t0 = time.perf_counter()
    out = fn()
    return out, (time.perf_counter() - t0) * 1000.0


def vector_size(df: DataFrame, features: str = "features") -> int:
    """Width of a vector column: from ML attribute metadata when present,
    else from one row."""
    meta = df.schema[features].metadata.get("ml_attr", {})
    if meta.get("num_attrs"):
        return int(meta["num_attrs"])
    row = df.select(F.size(vector_to_array(F.col(features))).alias("n")).first()
    return int(row["n"]) if row else 0


def load_points(spark, path: str):
    """RDD of labelled points from text ``(label,features)``. The loader and its
    parser are the JVM's: the lineage holds no Python step."""
    from pyspark.mllib.util import MLUtils
    return MLUtils.loadLabeledPoints(spark.sparkContext, path)


@dataclass
class LabeledPoints:
    """RDD of labelled points for the RDD-based solvers, with its width."""
    rdd: Any
    num_features: int

    def cache(self) -> "LabeledPoints":
        self.rdd.cache()
        return self

    def unpersist(self) -> None:
        self.rdd.unpersist()

    def train_args(self) -> dict:
        # Zero start and labels already checked: the solver wrapper then skips
        # its own first-row and label-validation jobs on every fit.
        return {"initialWeights": [0.0] * self.num_features, "validateData": False}


def labeled_points(df: DataFrame, label: str = "label", features: str = "features") -> LabeledPoints:
    """DataFrame -> labelled points for the RDD-based solvers.

    Each row becomes the line ``(label,vector)`` (sparse vectors stay sparse,
    doubles in their exact decimal form), written at the input's own
    parallelism and loaded by the JVM. A label other than 0 or 1 fails the
    write."""
    spark = df.sparkSession
    y = F.col(label).cast("double")
    checked = F.when(y.isin(0.0, 1.0), y).otherwise(F.raise_error(
        F.concat(F.lit("label must be 0 or 1, got "), F.coalesce(F.col(label).cast("string"), F.lit("NULL")))).cast("double"))
    n = vector_size(df, features)
    path = scratch_path(spark, "labeled-points")
    df.select(F.concat(F.lit("("), checked.cast("string"), F.lit(","), F.col(features).cast("string"), F.lit(")"))
              .alias("value")).write.text(path)
    return LabeledPoints(load_points(spark, path), n)


LITERAL_WEIGHTS = 256      # up to so many weights stand in the scoring expression itself


def weighted_margin(df: DataFrame, features: str, weights: list[float], intercept: float,
                    max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` with the column ``margin`` for any number of weights; the plan's size does not depend on it.

    Weights are a written table. Under the bound they are broadcast as one row and looked up by the active entries of
    each vector; beyond it, active entries meet the weights by index and are summed up by row."""
    spark, names = df.sparkSession, df.columns
    if 8 * len(weights) <= max_broadcast_bytes:
        row = written(spark.createDataFrame([(weights,)], "w array<double>"), "weights")
        return (df.crossJoin(F.broadcast(row.withColumnRenamed("w", "_w")))
                .select(*[F.col(f"`{c}`") for c in names], sparse_margin(active_entries(features), F.col("_w"), intercept).alias("margin")))
    table = written(spark.createDataFrame(list(enumerate(map(float, weights))), "i int, w double"), "weights")
    rows = written(df.withColumn("_row", F.monotonically_increasing_id()), "scored-rows")        # numbered once, then read
    e = active_entries(features)
    flat = rows.select("_row", F.explode(F.arrays_zip(e["indices"].alias("i"), e["values"].alias("x"))).alias("e")).select("_row", "e.i", "e.x")
    sums = flat.join(table, "i").groupBy("_row").agg(F.sum(F.col("x") * F.col("w")).alias("_sum"))
    return rows.join(sums, "_row", "left").select(*[F.col(f"`{c}`") for c in names],
                                                  (F.coalesce("_sum", F.lit(0.0)) + F.lit(float(intercept))).alias("margin"))


@dataclass
class LinearScorer:
    """Scores ``w.x + b`` inside the JVM. ``kind='logistic'``: score is the
    probability, class 1 when above ``threshold`` (0.5); ``kind='svm'``:
    score is the margin, class 1 when above ``threshold`` (0.0).
    ``threshold=None`` (a cleared threshold) still reports the raw score and
    applies the default cut for ``prediction``."""
    weights: list[float]
    intercept: float
    kind: str
    threshold: float | None = None
    features: str = "features"

    def __call__(self, df: DataFrame) -> DataFrame:
        if len(self.weights) > LITERAL_WEIGHTS:
            df = weighted_margin(df, self.features, self.weights, self.intercept)
            m = F.col("margin")
        else:
            m = linear_margin(vector_to_array(F.col(self.features), "float64"), self.weights, self.intercept)
        if self.kind == "logistic":
            score, cut = sigmoid(m), 0.5 if self.threshold is None else self.threshold
        else:
            score, cut = m, 0.0 if self.threshold is None else self.threshold
        out = df.withColumn("score", score).withColumn("prediction", (F.col("score") > cut).cast("double"))
        return out.drop("margin") if len(self.weights) > LITERAL_WEIGHTS else out


def fit_lr_sgd(df: DataFrame, iterations: int = 5, step: float = 50.0, mini_batch: float = 0.5,
               reg: float = 0.0, intercept: bool = False, points=None) -> Fitted:
    """M1: logistic regression by mini-batch SGD (no regularisation unless
    given, as in the 4-argument Scala ``train``). ``points``: the training
    set already converted by ``labeled_points`` (shared by a grid search)."""
    from pyspark.mllib.classification import LogisticRegressionWithSGD
    pts = points if points is not None else labeled_points(df)
    model, ms = _timed(lambda: LogisticRegressionWithSGD.train(
        pts.rdd, iterations=int(iterations), step=float(step), miniBatchFraction=float(mini_batch),
        regParam=float(reg), intercept=intercept, **pts.train_args()))
    sc = LinearScorer(list(map(float, model.weights)), float(model.intercept), "logistic")
    return Fitted("lr_sgd", {"iterations": iterations, "step": step, "mini_batch": mini_batch}, model, ms, sc)


def fit_svm_sgd(df: DataFrame, iterations: int = 25, step: float = 50.0, reg: float = 1.0,
                mini_batch: float = 1.0, intercept: bool = False, points=None) -> Fitted:
    """M4: linear SVM by SGD (hinge loss, L2)."""
    from pyspark.mllib.classification import SVMWithSGD
    pts = points if points is not None else labeled_points(df)
    model, ms = _timed(lambda: SVMWithSGD.train(
        pts.rdd, iterations=int(iterations), step=float(step), regParam=float(reg),
        miniBatchFraction=float(mini_batch), intercept=intercept, **pts.train_args()))
    sc = LinearScorer(list(map(float, model.weights)), float(model.intercept), "svm")
    return Fitted("svm_sgd", {"iterations": iterations, "step": step, "reg": reg}, model, ms, sc)


# How the learners of the batched solver score.
SGD_KINDS = {"lr_sgd": "logistic", "svm_sgd": "svm"}


def from_batch(name: str, params: dict, found: BatchFit) -> Fitted:
    return Fitted(name, params, found, found.train_ms, LinearScorer(found.weights, 0.0, SGD_KINDS[name]))


def fit_sgd(name: str, df: DataFrame, data: TrainingTable | None = None, **params) -> Fitted:
    """M1/M4 by the batched solver: the rule of the RDD solvers, with mini-batches by row hash."""
    kind = SGD_KINDS[name]
    params = {**(LR_SGD_DEFAULTS if kind == "logistic" else SVM_SGD_DEFAULTS), **params}
    return from_batch(name, params, fit_batch(data or training_table(df), kind, [params])[0])


def _ml_scorer(model, score_from: str = "probability"):
    def score(df: DataFrame) -> DataFrame:
        out = model.transform(df)
        s = vector_to_array(F.col(score_from), "float64")[1]
        return out.withColumn("score", s)
    return score


def fit_lr_lbfgs(df: DataFrame, reg: float = 0.0, intercept: bool = False,
                 max_iter: int = 100) -> Fitted:
    """M2: logistic regression by L-BFGS, two classes, no intercept by default."""
    est = LogisticRegression(maxIter=max_iter, regParam=reg, fitIntercept=intercept,
                             family="binomial", standardization=False)
    model, ms = _timed(lambda: est.fit(df))
    return Fitted("lr_lbfgs", {"reg": reg, "intercept": intercept}, model, ms, _ml_scorer(model))


def fit_lr_elasticnet(df: DataFrame, max_iter: int = 10, reg: float = 0.3,
                      elastic_net: float = 0.8) -> Fitted:
    """M3: logistic regression with an elastic-net penalty (training summary
    available as ``fitted.model.summary``)."""
    est = LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic_net)
    model, ms = _timed(lambda: est.fit(df))
    return Fitted("lr_elasticnet", {"max_iter": max_iter, "reg": reg, "elastic_net": elastic_net},
                  model, ms, _ml_scorer(model))


def fit_linear_svc(df: DataFrame, max_iter: int = 25, reg: float = 1.0) -> Fitted:
    """M4 (DataFrame form): linear SVM by OWL-QN, no step size."""
    est = LinearSVC(maxIter=max_iter, regParam=reg, fitIntercept=False, standardization=False)
    model, ms = _timed(lambda: est.fit(df))
    return Fitted("linear_svc", {"max_iter": max_iter, "reg": reg}, model, ms,
                  _ml_scorer(model, "rawPrediction"))


def fit_decision_tree(df: DataFrame, impurity: str = "entropy", max_depth: int = 10,
                      max_bins: int = 10, seed: int = 0) -> Fitted:
    """M5: decision tree, all features continuous (attribute metadata from
    one-hot encoding is dropped, as with an empty categorical-feature map)."""
    est = DecisionTreeClassifier(impurity=impurity, maxDepth=int(max_depth), maxBins=int(max_bins),
                                 seed=seed)
    cont = df.withColumn("features", continuous("features"))
    model, ms = _timed(lambda: est.fit(cont))

    def score(d: DataFrame) -> DataFrame:
        out = model.transform(d.withColumn("features", continuous("features")))
        return out.withColumn("score", vector_to_array(F.col("probability"), "float64")[1])
    return Fitted("decision_tree", {"impurity": impurity, "max_depth": max_depth, "max_bins": max_bins},
                  model, ms, score)


# Learners fed from an RDD of labelled points (converted once per data set).
RDD_LEARNERS = ("lr_sgd", "svm_sgd")

LEARNERS = {
    "lr_sgd": fit_lr_sgd,
    "svm_sgd": fit_svm_sgd,
    "lr_lbfgs": fit_lr_lbfgs,
    "lr_elasticnet": fit_lr_elasticnet,
    "linear_svc": fit_linear_svc,
    "decision_tree": fit_decision_tree,
}


def fit(name: str, df: DataFrame, **params) -> Fitted:
    return LEARNERS[name](df, **params)
