"""Batched gradient descent: equal to single fits, to NumPy, and on any partitioning; scoring with many weights."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from verdant.functions.vectors import active_entries
from verdant.operators import batched_sgd as B
from verdant.operators import tune as T
from verdant.operators.learners import LinearScorer, fit, fit_sgd, weighted_margin
from verdant.operators.tune import LR_GRID, SVM_GRID, expand


def _rows(seed, n, d, sparse=True):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, d)) * (rng.random((n, d)) < 0.6 if sparse else 1)
    y = (X @ np.linspace(-1, 2, d) + rng.normal(scale=0.4, size=n) > 0).astype(float)
    return X, y


def _frame(spark, X, y):
    rows = [(f"k{i}", float(t), Vectors.sparse(len(x), {j: float(v) for j, v in enumerate(x) if v}) if i % 2 else Vectors.dense(x.tolist()))
            for i, (x, t) in enumerate(zip(X, y))]
    return spark.createDataFrame(rows, ["url", "label", "features"])


@pytest.mark.parametrize("learner,grid", [("lr_sgd", LR_GRID), ("svm_sgd", SVM_GRID)])
def test_every_grid_point_equals_its_single_fit(spark, learner, grid, monkeypatch):
    X, y = _rows(0, 90, 4)
    df = _frame(spark, X, y).repartition(3)
    points = [p for p in expand(grid) if p.get("mini_batch", 1.0) == 1.0]
    passes = []
    monkeypatch.setattr(B, "_gradients", lambda *a, f=B._gradients: passes.append(a[4]) or f(*a))
    found = B.fit_batch(B.training_table(df), T.SGD_KINDS[learner], points)
    assert len(passes) <= max(p["iterations"] for p in points)
    for p, f in list(zip(points, found))[::3]:
        single = fit(learner, df, **p)
        np.testing.assert_allclose(f.weights, np.array(single.model.weights), rtol=1e-6, atol=1e-6)


def test_mini_batches_do_not_depend_on_partitions(spark):
    X, y = _rows(1, 200, 5)
    df = _frame(spark, X, y)
    setting = [{"iterations": 6, "step": 2.0, "mini_batch": s} for s in (0.5, 0.8)]
    one, many = (B.fit_batch(B.training_table(df.repartition(n)), "logistic", setting) for n in (1, 64))
    for a, b in zip(one, many):
        np.testing.assert_allclose(a.weights, b.weights, rtol=1e-12, atol=1e-12)
    # The same batches, by NumPy.
    hashes = {(r.url, t): r.h for t in range(1, 7) for r in
              df.withColumn("row_hash", F.xxhash64("url")).select("url", F.pmod(F.xxhash64("row_hash", F.lit(t)), F.lit(1 << 31)).alias("h")).collect()}
    w = np.zeros(5)
    for t in range(1, 7):
        inside = np.array([hashes[f"k{i}", t] < int(0.5 * (1 << 31)) for i in range(200)])
        assert 60 < inside.sum() < 140
        g = ((1 / (1 + np.exp(-X[inside] @ w)) - y[inside])[:, None] * X[inside]).mean(axis=0)
        w = w - 2.0 / np.sqrt(t) * g
    np.testing.assert_allclose(one[0].weights, w, rtol=1e-9, atol=1e-9)


def test_search_evaluates_like_single_models(spark):
    X, y = _rows(2, 120, 4)
    df = _frame(spark, X, y)
    train, valid = df.where(F.col("url") < "k7"), df.where(F.col("url") >= "k7")
    points = T.run_points("lr_sgd", train, valid, [{"iterations": i, "step": s, "mini_batch": 1.0} for i in (1, 4) for s in (1.0, 10.0)])
    for p in points:
        assert p.auc == T.evaluate(fit_sgd("lr_sgd", train, **p.params), valid)
    model, best, all_points = T.cross_grid("svm_sgd", train, valid, {"iterations": [2, 5], "step": [1.0], "reg": [0.1]})
    assert best.auc == max(p.auc for p in all_points) and len(all_points) == 2
    assert model.params["iterations"] == best.params["iterations"]


@pytest.mark.parametrize("learner", ["lr_sgd", "svm_sgd"])
def test_sweeps_and_grid_share_their_passes(spark, learner, monkeypatch):
    X, y = _rows(8, 120, 4)
    df = _frame(spark, X, y)
    train, valid = df.where(F.col("url") < "k7"), df.where(F.col("url") >= "k7")
    other = {"lr_sgd": {"mini_batch": [0.5, 1.0]}, "svm_sgd": {"reg": [0.1, 1.0]}}[learner]
    sweeps, grid = [("iterations", {"iterations": [1, 4], "step": [2.0], **other})], {"iterations": [2, 3], "step": [0.5, 2.0], **other}
    alone = T.cross_grid(learner, train, valid, grid)
    swept = T.sweep_all(spark, learner, train, valid, sweeps).drop("train_ms").collect()
    passes, seen = [], []
    monkeypatch.setattr(B, "_gradients", lambda *a, f=B._gradients: passes.append(a[4]) or f(*a))
    model, best, report = T.tune(spark, learner, train, valid, sweeps, grid, on_sweep=seen.append)
    assert passes == [1, 2, 3, 4, *range(1, best.params["iterations"] + 1)]         # the search, then the refit
    assert (best.index, best.params, best.auc) == (alone[1].index, alone[1].params, alone[1].auc)
    np.testing.assert_allclose(model.scorer.weights, alone[0].scorer.weights, rtol=1e-12, atol=1e-12)
    np.testing.assert_allclose(model.scorer.weights, fit_sgd(learner, train.unionByName(valid), **best.params).scorer.weights, rtol=1e-12, atol=1e-12)
    assert report.drop("train_ms").collect() == swept and seen == [report]


def test_a_pass_adds_up_rows_in_arrow_batches(spark, monkeypatch):
    """No row an entry is made; rows without entries count, and a step meets what NumPy gives, over several batches."""
    X, y = _rows(9, 70, 6)
    X[::9] = 0.0
    data = B.training_table(_frame(spark, X, y).coalesce(2))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
    try:
        w = np.random.default_rng(4).normal(size=(3, 6))
        for kind in ("logistic", "svm"):
            got, n = B._gradients(data, kind, w, [1.0, 1.0, 1.0], 1)
            m = X @ w.T
            slope = 1 / (1 + np.exp(-m)) - y[:, None] if kind == "logistic" else np.where((2 * y - 1)[:, None] * m < 1, (1 - 2 * y)[:, None], 0.0)
            np.testing.assert_allclose(got, slope.T @ X, rtol=1e-12, atol=1e-12)
            assert n.tolist() == [70.0] * 3
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    with monkeypatch.context() as m:
        m.setattr(F, "explode", None)
        assert B.fit_batch(data, "svm", [{"iterations": 1, "step": 1.0}])[0].iterations == 1


def test_many_weights_are_a_broadcast_row(spark, monkeypatch):
    X, y = _rows(5, 60, 4)
    data = B.training_table(_frame(spark, X, y))
    settings = [{"iterations": 3, "step": 1.0, "mini_batch": s, "reg": 0.1} for s in (0.5, 1.0)]
    plain = B.fit_batch(data, "svm", settings)
    counts = B.score_counts(data, "svm", [f.weights for f in plain])
    monkeypatch.setattr(B, "_LITERAL_CHARS", 0)
    assert [f.weights for f in B.fit_batch(data, "svm", settings)] == [f.weights for f in plain]
    assert B.score_counts(data, "svm", [f.weights for f in plain]) == counts


def test_edges(spark):
    X, y = _rows(3, 10, 3)
    df = _frame(spark, X, y)
    with pytest.raises(Exception, match="label must be 0 or 1"):
        B.training_table(df.withColumn("label", F.lit(2.0)))
    empty = B.training_table(df.where("false"))
    assert B.fit_batch(empty, "logistic", [{"iterations": 3, "step": 1.0}])[0].weights == []
    none = B.fit_batch(B.training_table(df), "logistic", [{"iterations": 0, "step": 1.0}])[0]
    assert none.weights == [0.0] * 3 and B.fit_batch(B.training_table(df), "svm", []) == []
    many = [{"iterations": 2, "step": 0.1 * k} for k in range(1, 31)]            # more than run together
    found = B.fit_batch(B.training_table(df), "svm", many)
    assert len({tuple(f.weights) for f in found}) == 30
    entries = df.select("features", active_entries("features").alias("e")).collect()
    for r in entries:
        assert r.features.toArray().tolist() == [dict(zip(r.e["indices"], r.e["values"])).get(j, 0.0) for j in range(3)]


def test_scoring_with_100_000_weights(spark):
    """A wide one-hot block: equal scores both ways, and a plan of constant size."""
    rng = np.random.default_rng(7)
    n = 100_000
    w = rng.normal(size=n).tolist()
    rows = [(f"u{i}", Vectors.sparse(n, sorted({int(j): float(j % 7) + 0.5 for j in rng.integers(0, n, 5)}.items()))) for i in range(60)]
    df = spark.createDataFrame([*rows, ("none", Vectors.sparse(n, []))], ["url", "features"])
    scorer = LinearScorer(w, 0.25, "svm")
    got = {r.url: r.score for r in scorer(df).collect()}
    expected = {u: 0.25 + sum(w[i] * x for i, x in zip(v.indices, v.values)) for u, v in rows} | {"none": 0.25}
    assert got == pytest.approx(expected, abs=1e-9)
    joined = {r.url: r.margin for r in weighted_margin(df, "features", w, 0.25, max_broadcast_bytes=1000).collect()}
    assert joined == pytest.approx(expected, abs=1e-9)
    size = lambda k: len(LinearScorer(w[:k], 0.0, "svm")(df)._jdf.queryExecution().optimizedPlan().toString())
    assert abs(size(n) - size(1000)) < 500
    assert LinearScorer(w, 0.0, "svm")(df).columns == ["url", "features", "score", "prediction"]
