"""Saved pipelines, rejected input, counts that ride along, tree tables, streams that are stopped and resumed."""

import os
import subprocess
import sys

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tests.conftest import ROOT, SF_SMALL
from verdant.operators.features import category_dictionary, fit_features, parse_pages
from verdant.operators.intake import observed_intake, split_rejects
from verdant.operators.learners import fit, fit_sgd
from verdant.operators.pipeline import page_pipeline
from verdant.operators.tree_table import NODES, node_table, score_nodes
from verdant.plans import catalog
from verdant.plans.jobs import prepare_pages, score_pages
from verdant.sources.pages import labelled_page_rows, unlabelled_page_rows
from verdant.streaming import error_filter as S

LOAD = """
import sys
from verdant.session import build_session
from verdant.operators.pipeline import score_saved
from verdant.operators.features import parse_pages
from verdant.sources.pages import unlabelled_page_rows
spark = build_session("local[2]", 4)
score_saved(sys.argv[1], parse_pages(unlabelled_page_rows(spark, sys.argv[2]), has_label=False)).write.parquet(sys.argv[3])
spark.stop()
"""


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("learner", ["lr_sgd", "decision_tree", "lr_lbfgs"])
def test_saved_pipeline_scores_alike(spark, tmp_path, learner):
    scale = learner != "decision_tree"
    parts, fm, _ = prepare_pages(labelled_page_rows(spark, SF_SMALL), scale=scale)
    model = fit_sgd("lr_sgd", parts["train"], iterations=3) if learner == "lr_sgd" else fit(learner, parts["train"])
    raw = unlabelled_page_rows(spark, SF_SMALL)
    expected = score_pages(raw, fm, model)
    path = str(tmp_path / "model")
    page_pipeline(spark, fm, model).write().save(path)
    if learner == "lr_sgd":                             # in a process of its own
        subprocess.run([sys.executable, "-c", LOAD, path, SF_SMALL, str(tmp_path / "out")], check=True, timeout=120,
                       cwd=ROOT, env={**os.environ, "PYTHONPATH": ROOT}, stderr=subprocess.DEVNULL)
        got = spark.read.parquet(str(tmp_path / "out"))
    else:
        from verdant.operators.pipeline import score_saved
        got = score_saved(path, parse_pages(raw, has_label=False))
    key = lambda d: {r.url: (round(r.score, 12), r.prediction, r.description) for r in d.collect()}
    assert key(got) == key(expected) and got.count() == raw.count()
    for p in parts.values():
        p.unpersist()
    with pytest.raises(Exception, match="already exists"):
        page_pipeline(spark, fm, model).write().save(path)
    page_pipeline(spark, fm, model).write().overwrite().save(path)


def test_saved_category_step_keeps_its_rule(spark, tmp_path):
    cols = ["url", "a", "b", "category", "x1", "label"]
    raw = spark.createDataFrame([("u1", "", "", "k1", "1", "1"), ("u2", "", "", "k2", "2", "0")], cols)
    new = spark.createDataFrame([("u3", "", "", "k9", "3", "1"), ("u4", "", "", "k1", "3", "1")], cols)
    parsed, other = parse_pages(raw, True), parse_pages(new, True)
    for unseen, expected in (("drop", 1), ("keep", 2)):
        path = str(tmp_path / unseen)
        page_pipeline(spark, fit_features(parsed, ("x1",), scale=False, unseen=unseen)).write().save(path)
        assert PipelineModel.load(path).transform(other).count() == expected
    path = str(tmp_path / "error")
    page_pipeline(spark, fit_features(parsed, ("x1",), scale=False)).write().save(path)
    with pytest.raises(Exception, match="unseen category"):
        PipelineModel.load(path).transform(other).collect()


def test_rejects_and_good_rows_are_the_input(spark):
    cols = ["url", "a", "b", "category", "x1", "x2", "label"]
    rows = [('"u1"', "", "", "k", '"1"', '"?"', '"1"'), ("u2", "", "", "k", "abc", "2", "0"), ("u3", "", "", "k", None, "x", "7"),
            ("u4", "", "", None, "1e3", " 5 ", "1.0"), ("u5", "", "", "k", "", "1", None)]
    good, rejects = split_rejects(spark.createDataFrame(rows, cols), has_label=True)
    assert {tuple(r) for r in rejects.collect()} == {
        ("u2", "x1", "abc", "not a number"), ("u3", "x1", None, "missing"), ("u3", "x2", "x", "not a number"),
        ("u3", "label", "7", "not 0 or 1"), ("u5", "x1", "", "not a number"), ("u5", "label", None, "missing")}
    assert {r.url: (r.category, r.x1, r.x2, r.label) for r in good.collect()} == {"u1": ("k", 1.0, 0.0, 1.0), "u4": (None, 1000.0, 5.0, 1.0)}
    assert good.count() + rejects.select("url").distinct().count() == len(rows)
    assert [d.count() for d in split_rejects(spark.createDataFrame([], "url string, a string, b string, category string, x1 string, label string"), True)] == [0, 0]


def test_observed_counts_take_no_scan_of_their_own(spark):
    session = spark.newSession()
    cols = ["url", "a", "b", "category", "x1"]
    raw = session.createDataFrame([("u1", "", "", "k1", "1"), ("u2", "", "", "k2", "z"), ("u3", "", "", "k3", "?"), ("u4", "", "", None, "2")], cols)
    known = session.createDataFrame([("k1",), ("k2",)], ["category"])
    out, seen = observed_intake(raw, category_dictionary(known), has_label=False)
    group = "observed-once"
    session.sparkContext.setJobGroup(group, group)
    rows = out.collect()
    jobs = len(session.sparkContext.statusTracker().getJobIdsForGroup(group))
    counts = {k: v for s in seen for k, v in s.get.items()}
    assert len(session.sparkContext.statusTracker().getJobIdsForGroup(group)) == jobs       # reading them runs nothing
    assert counts == {"rows": 4, "bad_rows": 1, "bad_fields": 1, "unseen_categories": 2}
    assert {r.url for r in rows} == {"u1", "u3", "u4"}


def test_fitted_tree_as_a_table(spark):
    data = spark.createDataFrame([(float((i * 7) % 3 == 0), Vectors.dense([float(i % 5), float(i % 7), i / 10])) for i in range(120)], ["label", "features"])
    model = fit("decision_tree", data, impurity="gini", max_depth=6, max_bins=16).model
    nodes = node_table(spark, model)
    assert nodes.count() == model.numNodes and nodes.where("left < 0").count() == (model.numNodes + 1) // 2
    both = score_nodes(model.transform(data).withColumnRenamed("prediction", "by_model"), nodes)
    assert both.where("by_model <> prediction").count() == 0 and both.count() == 120


def test_tree_tables_by_hand(spark):
    frame = lambda rows: spark.createDataFrame(rows, NODES)
    data = spark.createDataFrame([([1.0, 5.0],), ([2.0, 5.0],), ([2.0, 6.0],)], "x array<double>")
    tree = [(0, 0, 1.0, 1, 2, 0.0), (1, -1, None, -1, -1, 7.0), (2, 1, 5.0, 3, 4, 0.0), (3, -1, None, -1, -1, 8.0), (4, -1, None, -1, -1, 9.0)]
    assert [r.prediction for r in score_nodes(data, frame(tree), F.col("x")).collect()] == [7.0, 8.0, 9.0]
    assert [r.leaf for r in score_nodes(data, frame(tree[1:2]).withColumn("id", F.lit(0)), F.col("x")).collect()] == [0, 0, 0]
    for bad in (tree[:3], tree + [(7, -1, None, -1, -1, 0.0)], [(0, 0, 1.0, 0, 0, 0.0)], tree + [(5, -1, None, -1, -1, 0.0)]):
        with pytest.raises((ValueError, KeyError)):
            score_nodes(data, frame(bad), F.col("x"))


def _event_files(spark, path):
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(5, "event_id").write.parquet(path)
    return spark.read.parquet(path).where("contains(event_type, 'error')")


def test_stream_stopped_and_resumed(spark, tmp_path):
    path = str(tmp_path / "in")
    expected = _event_files(spark, path)
    out = S.run_error_filter_resumed(spark, path, S.EVENT_SCHEMA, col="event_type", stop_after=2)
    assert rows_of(out) == rows_of(expected)


def test_batch_cut_off_is_run_again(spark, tmp_path):
    """A batch that was written but not recorded as done, as after a crash, leaves no second copy."""
    path, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    expected = _event_files(spark, path)
    start = lambda: S.start_filter(S.file_stream(spark, path, S.EVENT_SCHEMA, max_files_per_trigger=1), out, ck, col="event_type", available_now=True)
    start().awaitTermination()
    commits = sorted((f for f in os.listdir(f"{ck}/commits") if f.isdigit()), key=int)
    assert len(commits) == 5                                                   # one file a batch
    for f in (commits[-1], f".{commits[-1]}.crc"):
        os.unlink(f"{ck}/commits/{f}")
    start().awaitTermination()
    assert sorted((f for f in os.listdir(f"{ck}/commits") if f.isdigit()), key=int) == commits
    assert rows_of(spark.read.parquet(out)) == rows_of(expected)


def test_elastic_net_is_not_flattened(spark):
    history = catalog.queries()["eval_objective_history"](spark, SF_SMALL).orderBy("iteration").collect()
    assert len(history) >= 3 and history[-1].loss < history[0].loss
    scores = catalog.queries()["m_lr_elasticnet"](spark, SF_SMALL)
    assert scores.select("score").distinct().count() > 100 and scores.first().summary_auc > 0.9
