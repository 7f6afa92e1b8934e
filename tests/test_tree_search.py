"""Tree searches: points that differ in their depth only are one fit, cut; equal to a fit of each point."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from verdant.operators import tune as T
from verdant.operators.learners import fit


def _frames(spark, n=400, seed=3):
    """Noisy labels, so that deep trees have leaves of all depths and prune."""
    rng = np.random.default_rng(seed)
    X = np.round(rng.normal(size=(n, 4)), 1) * (rng.random((n, 4)) < 0.7)
    y = (X[:, 0] + X[:, 1] * X[:, 2] + rng.normal(scale=0.7, size=n) > 0).astype(float)
    rows = [(f"k{i}", float(t), Vectors.sparse(4, {j: float(v) for j, v in enumerate(x) if v}) if i % 2 else Vectors.dense(x.tolist()))
            for i, (x, t) in enumerate(zip(X, y))]
    df = spark.createDataFrame(rows, ["url", "label", "features"]).coalesce(2)
    return df.where("substring(url, 2) % 4 > 0"), df.where("substring(url, 2) % 4 = 0")


GRID = {"impurity": ["gini", "entropy"], "max_depth": [0, 1, 3, 8, 20], "max_bins": [5, 40]}


def test_points_of_all_depths_are_one_fit_and_equal_their_own(spark, monkeypatch):
    train, valid = _frames(spark)
    points, fits = T.expand(GRID), []
    monkeypatch.setattr(T, "fit", lambda *a, **kw: fits.append(kw) or fit(*a, **kw))
    found = T.run_points("decision_tree", train, valid, points)
    assert len(fits) == 4 and all(kw["max_depth"] == 20 for kw in fits)
    assert [(g.index, g.params) for g in found] == list(enumerate(points))
    for g in found[::4]:
        assert g.auc == T.evaluate(fit("decision_tree", train, **g.params), valid)
    assert len({g.auc for g in found}) > 5 and all(g.train_ms > 0 for g in found)
    assert not spark.sparkContext._jsc.getPersistentRDDs()


@pytest.mark.parametrize("depths", [[2], [4, 2, 30, 0]])
def test_a_cut_tree_predicts_like_one_grown_to_that_depth(spark, depths):
    train, valid = _frames(spark, seed=5)
    deep = fit("decision_tree", train, max_depth=max(depths), max_bins=32)
    counts = T.tree_counts(deep, valid, depths)
    for d in depths:
        at = {(r.label, r.prediction): r["count"] for r in fit("decision_tree", train, max_depth=d, max_bins=32).transform(valid)
              .groupBy("label", "prediction").count().collect()}
        assert counts[d] == {n: at.get(k, 0) for n, k in (("tp", (1, 1)), ("fp", (0, 1)), ("fn", (1, 0)), ("tn", (0, 0)))}


def test_no_validation_rows_or_one_class(spark):
    train, valid = _frames(spark)
    points = [{"max_depth": d} for d in (1, 3)]
    for rows in (valid.where("false"), valid.where("label = 1")):
        assert [g.auc for g in T.run_points("decision_tree", train, rows, points)] == [None, None]
