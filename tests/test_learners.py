"""Learners pinned by NumPy re-computation and invariants."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from verdant.operators.learners import LinearScorer, fit
from verdant.operators.tune import expand, pick_best, GridPoint

# The 28 one-feature points (label, x).
POINTS_1D = [
    (0.0, 0.245), (0.0, 0.247), (1.0, 0.285), (1.0, 0.299), (1.0, 0.327), (1.0, 0.347),
    (0.0, 0.356), (1.0, 0.36), (0.0, 0.363), (1.0, 0.364), (0.0, 0.398), (1.0, 0.4),
    (0.0, 0.409), (1.0, 0.421), (0.0, 0.432), (1.0, 0.473), (1.0, 0.509), (1.0, 0.529),
    (0.0, 0.561), (0.0, 0.569), (1.0, 0.594), (1.0, 0.638), (1.0, 0.656), (1.0, 0.816),
    (1.0, 0.853), (1.0, 0.938), (1.0, 1.036), (1.0, 1.045),
]


def _vec_df(spark, rows):
    return spark.createDataFrame([(float(y), Vectors.dense(x)) for y, x in rows], ["label", "features"])


def test_lbfgs_one_feature_no_intercept(spark):
    df = _vec_df(spark, [(y, [x]) for y, x in POINTS_1D])
    f = fit("lr_lbfgs", df)
    w = f.model.coefficients[0]
    assert w == pytest.approx(1.9007, abs=2e-4) and f.model.intercept == 0.0
    probe = _vec_df(spark, [(0.0, [0.938])])
    assert f.transform(probe).first().prediction == 1.0


def numpy_lr_sgd(X, y, iters, step, tol=0.001):
    """Full-batch logistic SGD as the RDD solver runs it: w -= step/sqrt(t) * mean gradient,
    stopping when the step is below tol * max(|w|, 1)."""
    w = np.zeros(X.shape[1])
    for t in range(1, iters + 1):
        p = 1.0 / (1.0 + np.exp(-X @ w))
        g = ((p - y)[:, None] * X).mean(axis=0)
        new = w - step / np.sqrt(t) * g
        if t > 1 and np.linalg.norm(new - w) < tol * max(np.linalg.norm(new), 1.0):
            w = new
            break
        w = new
    return w


def test_lr_sgd_matches_numpy(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(60, 3))
    y = (X @ np.array([1.5, -2.0, 0.5]) + rng.normal(scale=0.3, size=60) > 0).astype(float)
    df = _vec_df(spark, [(y[i], X[i].tolist()) for i in range(60)])
    f = fit("lr_sgd", df, iterations=7, step=1.0, mini_batch=1.0)
    np.testing.assert_allclose(np.array(f.model.weights), numpy_lr_sgd(X, y, 7, 1.0), rtol=1e-6, atol=1e-9)
    # JVM-side scoring equals the solver's own predict
    scored = f.transform(df).select("features", "score", "prediction").collect()
    for r in scored[:10]:
        assert r.prediction == float(f.model.predict(r.features.toArray()))


def test_linear_scorer_svm_margin(spark):
    df = _vec_df(spark, [(1.0, [1.0, 2.0]), (0.0, [-1.0, 0.5])])
    out = LinearScorer([0.5, -1.0], 0.25, "svm")(df).orderBy("label").collect()
    assert [r.score for r in out] == pytest.approx([-0.5 - 0.5 + 0.25, 0.5 - 2.0 + 0.25])
    assert [r.prediction for r in out] == [0.0, 0.0]


def test_decision_tree_continuous_and_deterministic(spark):
    rng = np.random.default_rng(1)
    X = rng.integers(0, 2, size=(80, 4)).astype(float)
    y = ((X[:, 0] + X[:, 2]) >= 1).astype(float)
    df = _vec_df(spark, [(y[i], X[i].tolist()) for i in range(80)])
    a = fit("decision_tree", df, impurity="gini", max_depth=5, max_bins=32)
    b = fit("decision_tree", df, impurity="gini", max_depth=5, max_bins=32)
    body = lambda m: m.toDebugString.split("\n", 1)[1]  # first line holds the uid
    assert body(a.model) == body(b.model)
    assert "feature 0" in a.model.toDebugString and "<=" in a.model.toDebugString  # continuous splits
    pred = a.transform(df)
    assert pred.where(F.col("prediction") != F.col("label")).count() == 0


def test_tree_save_load_roundtrip(spark, tmp_path):
    from verdant.plans.jobs import tree_save_load
    df = _vec_df(spark, [(float(i % 2), [float(i % 2), 1.0]) for i in range(20)])
    m = fit("decision_tree", df, impurity="gini", max_depth=3, max_bins=8).model
    path = str(tmp_path / "tree")
    loaded, _, msg = tree_save_load(spark, m, path)
    assert msg == "saved" and loaded.toDebugString == m.toDebugString
    _, _, msg2 = tree_save_load(spark, m, path)
    assert msg2.startswith("output path already exists")


def test_svm_sgd_predictions_binary_and_repeatable(spark):
    rng = np.random.default_rng(2)
    X = rng.normal(size=(50, 3))
    y = (X[:, 0] > 0).astype(float)
    df = _vec_df(spark, [(y[i], X[i].tolist()) for i in range(50)])
    a = fit("svm_sgd", df, iterations=25, step=1.0, reg=0.01)
    b = fit("svm_sgd", df, iterations=25, step=1.0, reg=0.01)
    assert list(a.model.weights) == list(b.model.weights)
    preds = {r.prediction for r in a.transform(df).collect()}
    assert preds <= {0.0, 1.0}


def test_grid_expansion_order_and_tie_rule():
    pts = expand({"a": [1, 2], "b": ["x", "y"]})
    assert pts == [{"a": 1, "b": "x"}, {"a": 1, "b": "y"}, {"a": 2, "b": "x"}, {"a": 2, "b": "y"}]
    g = [GridPoint(0, {}, 0.7, 1.0), GridPoint(1, {}, 0.9, 1.0), GridPoint(2, {}, 0.9, 1.0),
         GridPoint(3, {}, 0.5, 1.0)]
    assert pick_best(g).index == 2


def test_text_classifier_scores_every_document(spark):
    from verdant.functions.text import tokenize_spaces
    from verdant.plans.jobs import train_spam_classifier
    spam = spark.createDataFrame([(1, "cheap money now"), (2, "win money money")], "id int, text string")
    ham = spark.createDataFrame([(3, "hi dad studying spark"), (4, "see you at dinner")], "id int, text string")
    m = train_spam_classifier(spam, ham, "id", "text", iterations=50)
    docs = spam.unionByName(ham).unionByName(spark.createDataFrame([(5, "")], "id int, text string"))
    out = {r.id: r.prediction for r in m.scorer.score(docs, "id", tokenize_spaces("text")).collect()}
    assert set(out) == {1, 2, 3, 4, 5}
    assert out[1] == 1.0 and out[2] == 1.0 and out[3] == 0.0
