"""Inputs are taken whole and at their own parallelism; nothing stays cached."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import __spark_entry__ as E
from verdant.functions.text import tokenize_spaces
from verdant.operators.features import category_dictionary, features_array, fit_features
from verdant.operators.hashed_text import fit_text_lr_sgd, point_lines
from verdant.operators.learners import fit, labeled_points
from verdant.operators.metrics import auc, score_curve
from verdant.plans.jobs import exact_summary, run_page_classification, tree_save_load
from verdant.session import ensure_checkpoint_dir
from verdant.sources.flags import parse_flags
from verdant.sources.pages import labelled_page_rows, unlabelled_page_rows

SF = "/root/testdata/sf0.001"


def vectors(spark, n=640, parts=64):
    rows = [(float(i % 2), Vectors.sparse(3, {0: float(i % 2), 2: 1.5}) if i % 3 else Vectors.dense([float(i % 2), 0.1, 1e-12]))
            for i in range(n)]
    return spark.createDataFrame(rows, ["label", "features"]).repartition(parts)


def test_sgd_input_keeps_its_partitions_and_stays_in_the_jvm(spark):
    df = vectors(spark)
    pts = labeled_points(df)
    assert pts.rdd.getNumPartitions() >= 60
    lineage = pts.rdd._jrdd.toDebugString()
    assert "PythonRDD" not in lineage
    got = sorted((p.label, tuple(p.features.toArray())) for p in pts.rdd.collect())
    assert got == sorted((r.label, tuple(r.features.toArray())) for r in df.collect())   # every double exact


def test_sgd_labels_are_checked(spark):
    df = spark.createDataFrame([(2.0, Vectors.dense([1.0]))], ["label", "features"])
    with pytest.raises(Exception, match="label must be 0 or 1"):
        labeled_points(df)


def test_learners_train_in_all_partitions(spark):
    """Tasks of the widest stage of a fit."""
    df = vectors(spark, parts=24)
    sc = spark.sparkContext
    sc.setJobGroup("fit", "fit")
    fit("linear_svc", df, max_iter=2)
    sc.setLocalProperty("spark.jobGroup.id", None)
    tracker, widest = sc.statusTracker(), 0
    for job in tracker.getJobIdsForGroup("fit"):
        for stage in tracker.getJobInfo(job).stageIds:
            info = tracker.getStageInfo(stage)
            widest = max(widest, info.numTasks if info else 0)
    assert widest >= 24


def test_duplicate_ids_stay_apart(spark):
    docs = spark.createDataFrame([(1, "a b", 1.0), (1, "c", 0.0), (2, "a a", 1.0), (3, None, 0.0)], "id long, text string, label double")
    lines = [r.value for r in point_lines(docs, tokenize_spaces("text"), F.col("label"), 1000).collect()]
    assert sorted((x[1:4], x.count(".0") - 1) for x in lines) == [("0.0", 0), ("0.0", 1), ("1.0", 1), ("1.0", 2)]
    model = fit_text_lr_sgd(docs, "id", tokenize_spaces("text"), num_features=1000, iterations=20)
    scored = model.scorer.score(docs, "id", tokenize_spaces("text")).collect()
    assert sorted(r.id for r in scored) == [1, 1, 2, 3]
    assert {r.prediction for r in scored if r.id == 1} == {0.0, 1.0}


def test_existing_tree_is_not_taken_for_the_saved_one(spark, tmp_path):
    df = vectors(spark, 60, 2)
    shallow, deep = (fit("decision_tree", df, max_depth=d).model for d in (1, 4))
    path = str(tmp_path / "tree")
    loaded, _, msg = tree_save_load(spark, shallow, path)
    assert loaded.toDebugString == shallow.toDebugString and msg == "saved"
    loaded, _, msg = tree_save_load(spark, deep, path)
    assert loaded is None and "exists" in msg
    assert tree_save_load(spark, deep, path, overwrite=True)[0].toDebugString == deep.toDebugString


def test_summary_is_exact(spark):
    df = spark.range(3000).select((F.rand(3) < F.col("id") / 3000).cast("double").alias("label"), F.col("id").alias("i"))
    df = spark.createDataFrame([(r.label, Vectors.dense([r.i / 3000.0])) for r in df.collect()], ["label", "features"])
    f = fit("lr_elasticnet", df, reg=0.01, elastic_net=0.0)
    t, a = exact_summary(f, df)
    rows = [(r.score, r.label) for r in f.transform(df).select("score", "label").collect()]
    best = max({s for s, _ in rows}, key=lambda c: (2 * sum(y for s, y in rows if s >= c) / (
        sum(y for _, y in rows) + sum(s >= c for s, _ in rows)), c))
    assert t == best and f.model.getThreshold() == t
    assert a == auc(score_curve(f.transform(df), buckets=1)).first().auc


def test_bad_csv_fails(spark):
    lines = spark.createDataFrame([("1,0,x,0,0,1,1,1",)], "value string")
    with pytest.raises(Exception):
        parse_flags(lines).collect()


def test_ten_thousand_and_one_categories(spark):
    n = 10_001
    df = spark.range(n).select(F.concat(F.lit("c"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("category"),
                               F.col("id").cast("double").alias("x"))
    rows = category_dictionary(df).orderBy("category").collect()
    assert [r.category_index for r in rows] == list(range(n))
    fm = fit_features(df, ["x"], scale=False)
    row = fm.transform(df.where("x = 7")).first()
    assert row.features.size == n + 1 and row.features.toArray().nonzero()[0].tolist() == [7, n]


RAW = [(f"u{i}", "", "", f"c{i % 3}", str(i), "?" if i % 4 else "2", str(i % 2)) for i in range(60)]
NAMES = "url string, a string, b string, cat string, x1 string, x2 string"


@pytest.mark.parametrize("unseen, n", [("keep", 3), ("drop", 2)])
def test_unseen_modes(spark, unseen, n):
    train = spark.createDataFrame(RAW, NAMES + ", y string")
    pages = spark.createDataFrame([("p1", "", "", "c0", "1", "2"), ("p2", "", "", "c1", "1", "?"), ("p3", "", "", "new", "1", "2")], NAMES)
    run = run_page_classification(spark, train, pages, learner="lr_sgd", unseen=unseen)
    assert run.scored.count() == n
    run.unpersist()
    run = run_page_classification(spark, train, pages, learner="lr_sgd")
    run.unpersist()
    with pytest.raises(Exception, match="unseen category new"):
        run.scored.collect()


@pytest.mark.parametrize("on_bad, n", [("zero", 2), ("null", 1)])
def test_bad_number_modes(spark, on_bad, n):
    train = spark.createDataFrame(RAW, NAMES + ", y string")
    pages = spark.createDataFrame([("p1", "", "", "c0", "1", "2"), ("p2", "", "", "c1", "one", "?")], NAMES)
    run = run_page_classification(spark, train, pages, learner="decision_tree", on_bad=on_bad)
    assert run.scored.count() == n
    run.unpersist()
    run = run_page_classification(spark, train, pages, learner="decision_tree")
    run.unpersist()
    with pytest.raises(Exception):
        run.scored.collect()


def test_stream_reads_a_table_of_many_files(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    batch = E.queries()["filter_contains"](spark, SF).count()
    assert E.queries()["stream_error_filter"](spark, str(tmp_path)).count() == batch > 0
    assert E.queries()["stream_error_filter"](spark, SF).count() == batch


def test_queries_leave_nothing_cached(spark):
    persisted = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    spark.catalog.clearCache()
    before = persisted()
    for name in ("eval_roc", "page_classification", "m_lr_sgd", "flag_metrics", "category_onehot"):
        E.queries()[name](spark, SF).collect()
    assert persisted() <= before


def test_no_local_scratch_off_a_local_master(spark):
    class Fake:
        master = "yarn"
        def getCheckpointDir(self): return None
        def getConf(self): return self
        def get(self, *_): return None

    class Session:
        sparkContext = Fake()
        conf = Fake()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_page_run_and_features_read_documents_once(spark):
    df = labelled_page_rows(spark, SF)
    fm = fit_features(df.selectExpr("category", "1.0D as x"), ["x"], scale=False)
    assert fm.transform(df.selectExpr("category", "1.0D as x")).select(features_array().alias("f")).count() == df.count()
    assert unlabelled_page_rows(spark, SF).count() == 50
