"""Exact curves and metrics against brute-force Python models."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from verdant.operators.metrics import (accuracy, auc, auc_hard, best_of_grid, best_threshold,
                                       f_measure_by_threshold, grid_auc_hard, roc_curve,
                                       score_curve, success_rate)


def brute(pairs):
    P = sum(y for _, y in pairs)
    N = len(pairs) - P
    out = {}
    for t in sorted({s for s, _ in pairs}, reverse=True):
        tp = sum(1 for s, y in pairs if s >= t and y == 1)
        fp = sum(1 for s, y in pairs if s >= t and y == 0)
        out[t] = (tp, fp)
    # Mann-Whitney with ties counted half
    a = None
    if P and N:
        a = sum((1.0 if sp > sn else 0.5 if sp == sn else 0.0)
                for sp, yp in pairs if yp == 1 for sn, yn in pairs if yn == 0) / (P * N)
    return P, N, out, a


def frame(spark, pairs):
    return spark.createDataFrame([(float(s), float(y)) for s, y in pairs], "score double, label double")


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 1)), min_size=1, max_size=60),
       st.integers(1, 9))
def test_curve_auc_match_brute_force(spark, pairs, buckets):
    P, N, pts, a = brute(pairs)
    curve = score_curve(frame(spark, pairs), buckets=buckets)
    got = {r.score: (r.tp, r.fp) for r in curve.collect()}
    assert got == {float(k): v for k, v in pts.items()}
    got_auc = auc(curve).first().auc
    if a is None:
        assert got_auc is None
    else:
        assert got_auc == pytest.approx(a, abs=1e-12)


def test_roc_ends_and_f_measure(spark):
    pairs = [(0.9, 1), (0.8, 0), (0.8, 1), (0.3, 0), (0.1, 1)]
    curve = score_curve(frame(spark, pairs), buckets=3)
    roc = sorted((r.fpr, r.tpr) for r in roc_curve(curve).collect())
    assert roc[0] == (0.0, 0.0) and roc[-1] == (1.0, 1.0) and len(roc) == 6
    fm = {r.threshold: r.f_measure for r in f_measure_by_threshold(curve).collect()}
    # at 0.8: tp=2 fp=1 P=3 -> p=2/3 r=2/3 -> F=2/3
    assert fm[0.8] == pytest.approx(2 / 3)


def test_best_threshold_ties_take_highest(spark):
    # thresholds 0.9 and 0.5 both reach F = 2/3 with P = 2
    pairs = [(0.9, 1), (0.5, 1), (0.5, 0), (0.4, 0)]
    fm = f_measure_by_threshold(score_curve(frame(spark, pairs)))
    rows = {r.threshold: r.f_measure for r in fm.collect()}
    assert rows[0.9] == pytest.approx(2 / 3) and rows[0.5] == pytest.approx(0.8)
    pairs2 = [(0.9, 1), (0.8, 0), (0.7, 1), (0.1, 0)]
    fm2 = f_measure_by_threshold(score_curve(frame(spark, pairs2)))
    b = best_threshold(fm2).first()
    assert b.threshold == 0.7 and b.f_measure == pytest.approx(0.8)


def test_one_class_and_all_equal(spark):
    assert auc(score_curve(frame(spark, [(0.2, 1), (0.4, 1)]))).first().auc is None
    assert auc(score_curve(frame(spark, [(0.5, 1), (0.5, 0), (0.5, 0)]))).first().auc == pytest.approx(0.5)


def test_hard_auc_is_balanced_accuracy(spark):
    rnd = random.Random(5)
    rows = [(float(rnd.randint(0, 1)), float(rnd.randint(0, 1))) for _ in range(200)]
    df = spark.createDataFrame(rows, "prediction double, label double")
    tp = sum(1 for p, y in rows if p == 1 and y == 1)
    fn = sum(1 for p, y in rows if p == 0 and y == 1)
    fp = sum(1 for p, y in rows if p == 1 and y == 0)
    tn = sum(1 for p, y in rows if p == 0 and y == 0)
    expect = (tp / (tp + fn) + tn / (tn + fp)) / 2
    assert auc_hard(df).first().auc == pytest.approx(expect, abs=1e-15)
    assert accuracy(df).first().accuracy == pytest.approx((tp + tn) / 200)
    s = success_rate(df).first()
    assert (s.success, s.total) == (tp + tn, 200)


def test_grid_ties_last_wins(spark):
    df = frame(spark, [(0.9, 1), (0.2, 0), (0.6, 1), (0.1, 0)])
    g = grid_auc_hard(df.withColumnRenamed("score", "score"), [0.3, 0.5, 0.55, 0.95])
    aucs = {r.grid_index: r.auc for r in g.collect()}
    assert aucs[0] == aucs[1] == aucs[2] == 1.0
    assert best_of_grid(g).first().grid_index == 2


def test_large_distinct_scores_many_buckets(spark):
    rnd = random.Random(11)
    pairs = [(rnd.random(), rnd.randint(0, 1)) for _ in range(3000)]
    P, N, _, _ = brute(pairs[:0] or [(0, 0)])
    curve = score_curve(frame(spark, pairs), buckets=16)
    rows = sorted(((r.score, r.tp, r.fp) for r in curve.collect()), reverse=True)
    tp = fp = 0
    for (s, rtp, rfp), (ps, py) in zip(rows, sorted(pairs, reverse=True)):
        tp += py
        fp += 1 - py
        assert (rtp, rfp) == (tp, fp)


def test_missing_score_fails(spark):
    rows = spark.createDataFrame([(0.2, 1.0), (None, 1.0), (0.4, 0.0)], "score double, label double")
    with pytest.raises(Exception, match="no score"):
        auc(score_curve(rows)).collect()


def test_more_buckets_than_default_accuracy(spark):
    rows = spark.range(4000).selectExpr("cast(id as double) as score", "cast(id % 3 = 0 as double) as label")
    few, many = (sorted(tuple(r) for r in score_curve(rows, buckets=b).collect()) for b in (1, 2000))
    assert few == many
