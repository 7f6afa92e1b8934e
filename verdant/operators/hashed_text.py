"""Hashed term-frequency features and a linear text classifier.

Terms are hashed into ``num_features`` buckets with Spark's Murmur3
``hash()`` (seed 42): ``bucket = pmod(hash(term), num_features)``. The same
expression serves training and scoring, so both see one feature space.

* ``hashed_tf``: ``(id, bucket, tf)`` rows, a partial/final aggregate.
* Training packs each row's buckets into one sparse labelled point (bounded by
  ``num_features`` entries) for the SGD solver. Rows are told apart by id and
  text, never by their place, which a recomputed task may change; equal rows are
  counted and come back as often.
* Scoring never builds vectors: tokens are joined to the weight table
  (``num_features`` rows, a proven bound, broadcast) and summed per document.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.functions.vectors import sigmoid
from verdant.operators.learners import Fitted, load_points
from verdant.session import scratch_path

NUM_FEATURES = 25000


def term_bucket(term, num_features: int = NUM_FEATURES) -> Column:
    t = F.col(term) if isinstance(term, str) else term
    return F.pmod(F.hash(t), F.lit(num_features))


def hashed_tf(docs: DataFrame, id_col: str, tokens: Column,
              num_features: int = NUM_FEATURES) -> DataFrame:
    """raw hashed counts, one row per (document, non-empty bucket)."""
    return (docs.select(F.col(id_col).alias("id"), F.explode(tokens).alias("term"))
            .select("id", term_bucket("term", num_features).alias("bucket"))
            .groupBy("id", "bucket").agg(F.count(F.lit(1)).cast("double").alias("tf")))


def _tokens_of_rows(docs: DataFrame, tokens: Column, *columns: Column) -> DataFrame:
    """``(key, *columns, term, head)``, one row a token or, without tokens, one row: ``key`` is the hash of the tokens,
    ``head`` is 1 in one row of each input row."""
    rows = docs.select(*columns, tokens.alias("terms"))
    key = F.md5(F.concat_ws(":", F.coalesce(F.size("terms"), F.lit(-1)).cast("string"), F.concat_ws("\x00", "terms")))
    names = [c for c in rows.columns if c != "terms"]
    # The key is made below the explode: once a row, not once a token.
    flat = rows.select(F.unhex(key).alias("key"), *names, "terms").select("key", *names, F.posexplode_outer("terms").alias("at", "term"))
    return flat.withColumn("head", (F.coalesce("at", F.lit(0)) == 0).cast("int")).drop("at")


def point_lines(docs: DataFrame, tokens: Column, label: Column, num_features: int = NUM_FEATURES, id_col: str | None = None) -> DataFrame:
    """One line ``(label,(size,[buckets],[counts]))`` per row of ``docs``.

    Equal rows (``id_col``, label and tokens) are grouped, and their counts divided by how many they are: no row number
    is needed, so a task that runs again changes nothing. A row without tokens has no entries."""
    own = F.col(id_col).cast("string") if id_col else F.lit("")
    flat = _tokens_of_rows(docs, tokens, own.alias("id"), label.cast("double").alias("y"))
    bucket = F.when(F.col("term").isNotNull(), term_bucket("term", num_features))
    counts = (flat.select("key", "id", "y", bucket.alias("bucket"), "head").groupBy("key", "id", "y", "bucket")
              .agg(F.count(F.lit(1)).cast("double").alias("tf"), F.sum("head").alias("heads")))
    packed = counts.groupBy("key", "id", "y").agg(F.sum("heads").cast("int").alias("copies"), F.sort_array(F.collect_list(
        F.when(F.col("bucket").isNotNull(), F.struct("bucket", "tf")))).alias("e"))
    each = packed.select("y", "e", "copies", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    listed = lambda c: F.array_join(c.cast("array<string>"), ",")
    tf = F.transform("e.tf", lambda x: x / F.col("copies"))
    return each.select(F.concat(F.lit("("), F.col("y").cast("string"), F.lit(f",({num_features},["), listed(F.col("e.bucket")),
                                F.lit("],["), listed(tf), F.lit("]))")).alias("value"))


def fit_text_lr_sgd(docs: DataFrame, id_col: str, tokens: Column, label_col: str = "label",
                    num_features: int = NUM_FEATURES, iterations: int = 100, step: float = 1.0,
                    mini_batch: float = 1.0, reg: float = 0.01) -> Fitted:
    """Logistic regression by SGD on hashed term counts (defaults of
    the no-argument solver: 100 iterations, step 1, full batch, L2 0.01)."""
    from pyspark.mllib.classification import LogisticRegressionWithSGD

    path = scratch_path(docs.sparkSession, "hashed-points")
    point_lines(docs, tokens, F.col(label_col), num_features, id_col).write.text(path)
    rdd = load_points(docs.sparkSession, path)
    t0 = time.perf_counter()
    # Labels are 1.0/0.0 by construction: start from zeros, skip re-validation.
    model = LogisticRegressionWithSGD.train(rdd, iterations=iterations, step=step,
                                            miniBatchFraction=mini_batch, regParam=reg,
                                            initialWeights=[0.0] * num_features, validateData=False)
    ms = (time.perf_counter() - t0) * 1000.0
    spark = docs.sparkSession
    w = model.weights.toArray().tolist()
    scorer = HashedLinearScorer(spark, w, float(model.intercept), num_features)
    return Fitted("text_lr_sgd", {"iterations": iterations, "step": step, "mini_batch": mini_batch,
                                  "reg": reg}, model, ms, scorer)


class HashedLinearScorer:
    """Logistic score of hashed term counts: ``sigmoid(b + sum_t w[bucket(t)])``."""

    def __init__(self, spark: SparkSession, weights: list[float], intercept: float,
                 num_features: int = NUM_FEATURES, threshold: float = 0.5):
        self.num_features = num_features
        self.intercept = intercept
        self.threshold = threshold
        nz = [(i, float(x)) for i, x in enumerate(weights) if x != 0.0]
        self.weights = spark.createDataFrame(nz, "bucket int, w double")

    def score(self, docs: DataFrame, id_col: str, tokens: Column) -> DataFrame:
        # Rows that share an id are scored each; equal rows are scored once and come back as often.
        toks = _tokens_of_rows(docs, tokens, F.col(id_col).alias("id"))
        # hash(NULL) is the seed, so a document without tokens must not hash.
        b = toks.withColumn("bucket", F.when(F.col("term").isNotNull(),
                                             term_bucket("term", self.num_features).cast("int")))
        wt = F.broadcast(self.weights)      # at most num_features rows
        m = (b.join(wt, "bucket", "left").groupBy("key", "id")
             .agg(F.coalesce(F.sum("w"), F.lit(0.0)).alias("m"), F.sum("head").cast("int").alias("copies"))
             .select("id", (F.col("m") / F.col("copies")).alias("m"), F.explode(F.sequence(F.lit(1), F.col("copies")))))
        s = sigmoid(F.col("m") + F.lit(self.intercept))
        return m.select(F.col("id").alias(id_col), s.alias("score"),
                        (s > F.lit(self.threshold)).cast("double").alias("prediction"))

    __call__ = score
