"""Registered model queries.

Model outputs have no exact SQL twin (solvers are iterative), so these carry
no oracle; tests pin them with invariants and NumPy re-computation. What a
query keeps for training is released before it returns; fit times stay in the
operators' reports, so that reruns give the same rows."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from verdant.functions.text import tokenize_spaces
from verdant.operators.broadcast import broadcast_if_small
from verdant.operators.hashed_text import NUM_FEATURES, hashed_tf
from verdant.operators.learners import LR_SGD_DEFAULTS, SVM_SGD_DEFAULTS, TREE_DEFAULTS, fit
from verdant.operators.metrics import accuracy, auc, prediction_report, score_curve, success_rate
from verdant.operators.split import hash_split
from verdant.operators.tune import LR_GRID, LR_SWEEPS, SVM_GRID, SVM_SWEEPS, TREE_GRID, TREE_SWEEPS, cross_grid, evaluate, sweep_all
from verdant.plans.jobs import (DEFAULTS, SCALED, embeddings_by_sign, embeddings_labelled, exact_summary, flag_points, objective_history,
                                prepare_pages, release, run_page_classification, train_spam_classifier,
                                tree_save_load)
from verdant.plans.registry import query
from verdant.session import ensure_checkpoint_dir, written
from verdant.sources.flags import flag_lines
from verdant.sources.libsvm import read_libsvm, write_libsvm
from verdant.sources.pages import labelled_page_rows, unlabelled_page_rows
from verdant.sources.tables import spread, table


# Parameters, split weights and seeds of the classic jobs.
FLAG_SPLIT = (0.6, 0.4)
FLAG_SVM = {"iterations": 100, "step": 1.0, "reg": 0.01}
TREE_LIBSVM = {"impurity": "gini", "max_depth": 5, "max_bins": 32}
TREE_LIBSVM_SPLIT, TREE_LIBSVM_SEED = (0.7, 0.3), 3
LBFGS_LIBSVM_SPLIT, LBFGS_LIBSVM_SEED = (0.3, 0.7), 1
ELASTIC_NET = {"max_iter": 10, "reg": 0.3, "elastic_net": 0.8}


def _pages(spark, sf_dir):
    return labelled_page_rows(spark, sf_dir), unlabelled_page_rows(spark, sf_dir)


def _classify(spark, sf_dir, learner, **kw):
    train_raw, score_raw = _pages(spark, sf_dir)
    run = run_page_classification(spark, train_raw, score_raw, learner=learner, measure=False, **kw)
    run.unpersist()
    return run


@query("page_classification")
def q_page_classification(spark, sf_dir):
    """G6 flagship: labelled pages -> features -> 80/10/10 -> SGD logistic
    regression -> AUC -> score every unlabelled page with a description."""
    return _classify(spark, sf_dir, "lr_sgd").scored


@query("page_classification_svm")
def q_page_classification_svm(spark, sf_dir):
    """G6 with the SGD linear SVM."""
    return _classify(spark, sf_dir, "svm_sgd").scored


@query("page_classification_tree")
def q_page_classification_tree(spark, sf_dir):
    """G6 with the decision tree (entropy, depth 10, 10 bins)."""
    return _classify(spark, sf_dir, "decision_tree").scored


@query("score_refit_scaler")
def q_score_refit_scaler(spark, sf_dir):
    """F4x: scoring with the scaler re-fitted on the scoring rows."""
    return _classify(spark, sf_dir, "lr_sgd", refit_scaler=True).scored


@query("page_run_metrics")
def q_page_run_metrics(spark, sf_dir):
    """Validation and test AUC of the run with each learner's defaults."""
    rows, raw = [], labelled_page_rows(spark, sf_dir)
    for learners in (("lr_sgd", "svm_sgd"), ("decision_tree",)):          # of one scaling: prepared once
        parts, _, _ = prepare_pages(raw, SCALED[learners[0]])
        for learner in learners:
            model = fit(learner, parts["train"], **DEFAULTS[learner])
            rows.append((learner, evaluate(model, parts["validation"]), evaluate(model, parts["test"])))
        release(parts)
    return spark.createDataFrame(rows, "learner string, validation_auc double, test_auc double")


@query("page_classification_tuned")
def q_page_classification_tuned(spark, sf_dir):
    """G5/G6 with tuning: all sweeps, the cross grid, the refit; scores every page."""
    return _classify(spark, sf_dir, "lr_sgd", tune_params=True).scored


def _test_report(spark, sf_dir, learner, scale, **params):
    parts, _, _ = prepare_pages(labelled_page_rows(spark, sf_dir), scale)
    model = fit(learner, parts["train"], **params)
    out = written(prediction_report(model.transform(parts["test"]).select("url", "label", "score", "prediction")), "report")
    release(parts)
    return out


@query("m_lr_sgd")
def q_m_lr_sgd(spark, sf_dir):
    """M1 (+E11): SGD logistic regression, test-set report."""
    return _test_report(spark, sf_dir, "lr_sgd", True, **LR_SGD_DEFAULTS)


@query("m_svm_sgd")
def q_m_svm_sgd(spark, sf_dir):
    """M4: SGD linear SVM (25 iterations, step 50, reg 1), test-set report."""
    return _test_report(spark, sf_dir, "svm_sgd", True, **SVM_SGD_DEFAULTS)


@query("m_linear_svc")
def q_m_linear_svc(spark, sf_dir):
    """M4, DataFrame form: LinearSVC, test-set report."""
    return _test_report(spark, sf_dir, "linear_svc", True)


@query("m_dt")
def q_m_dt(spark, sf_dir):
    """M5: decision tree with continuous one-hot features, test-set report."""
    return _test_report(spark, sf_dir, "decision_tree", False, **TREE_DEFAULTS)


def _sweeps(spark, sf_dir, learner, sweeps):
    parts, _, _ = prepare_pages(labelled_page_rows(spark, sf_dir), SCALED[learner])
    out = sweep_all(spark, learner, parts["train"], parts["validation"], sweeps)
    release(parts)
    return out.drop("train_ms")


@query("tune_sweep")
def q_tune_sweep(spark, sf_dir):
    """The three decision-tree sweeps as a report table."""
    return _sweeps(spark, sf_dir, "decision_tree", TREE_SWEEPS)


@query("tune_sweep_lr")
def q_tune_sweep_lr(spark, sf_dir):
    """The three sweeps of the SGD logistic regression."""
    return _sweeps(spark, sf_dir, "lr_sgd", LR_SWEEPS)


@query("tune_sweep_svm")
def q_tune_sweep_svm(spark, sf_dir):
    """The three sweeps of the SGD linear SVM."""
    return _sweeps(spark, sf_dir, "svm_sgd", SVM_SWEEPS)


def _grid(spark, sf_dir, learner, grid, schema):
    parts, _, _ = prepare_pages(labelled_page_rows(spark, sf_dir), SCALED[learner])
    _, best, pts = cross_grid(learner, parts["train"], parts["validation"], grid, refit=False)
    release(parts)
    rows = [(p.index, *[p.params[k] for k in grid], p.auc, p.index == best.index) for p in pts]
    return spark.createDataFrame(rows, f"grid_index int, {schema}, auc double, best boolean")


@query("tune_grid")
def q_tune_grid(spark, sf_dir):
    """SGD logistic regression cross grid (36 points) in ten passes, best
    flagged (ties: last grid point)."""
    return _grid(spark, sf_dir, "lr_sgd", LR_GRID, "iterations int, step double, mini_batch double")


@query("tune_grid_svm")
def q_tune_grid_svm(spark, sf_dir):
    """SGD linear SVM cross grid (60 points)."""
    return _grid(spark, sf_dir, "svm_sgd", SVM_GRID, "iterations int, step double, reg double")


@query("tune_grid_tree")
def q_tune_grid_tree(spark, sf_dir):
    """Decision-tree cross grid (50 points)."""
    return _grid(spark, sf_dir, "decision_tree", TREE_GRID, "impurity string, max_depth int, max_bins int")


# ---- J5 ----------------------------------------------------------------------------

def _flag_split(spark, sf_dir):
    pts = written(flag_points(flag_lines(spark, sf_dir)), "flags").withColumn("key", F.col("barcode").cast("long"))
    return hash_split(pts, "key", FLAG_SPLIT, ("train", "test"))


@query("m_lr_lbfgs")
def q_m_lr_lbfgs(spark, sf_dir):
    """M2 (+E3): L-BFGS logistic regression on flag records, test predictions."""
    train, test = _flag_split(spark, sf_dir)
    model = fit("lr_lbfgs", train)
    return model.transform(test).select("barcode", "label", "prediction")


@query("m_svm_raw_scores")
def q_m_svm_raw_scores(spark, sf_dir):
    """SVM by SGD (100 iterations), cleared threshold: raw margins."""
    train, test = _flag_split(spark, sf_dir)
    model = fit("svm_sgd", train, **FLAG_SVM)
    return model.transform(test).select("barcode", "label", "score")


@query("flag_metrics")
def q_flag_metrics(spark, sf_dir):
    """J5 report (+E2, E3): accuracy of the L-BFGS model and AUC of the SVM's
    raw margins on the same test split, one row."""
    train, test = _flag_split(spark, sf_dir)
    lr = fit("lr_lbfgs", train).transform(test)
    svm = fit("svm_sgd", train, **FLAG_SVM).transform(test)
    acc = accuracy(lr).first()["accuracy"]
    raw_auc = auc(score_curve(svm.select("score", "label"))).first()["auc"]
    return spark.createDataFrame([(acc, raw_auc)], "lbfgs_accuracy double, svm_raw_auc double")


# ---- J3 / J4 -----------------------------------------------------------------------

def _emb(spark, sf_dir):
    return embeddings_labelled(table(spark, sf_dir, "embeddings"))


@query("m_dt_libsvm")
def q_m_dt_libsvm(spark, sf_dir):
    """M5b (+P3): gini tree, depth 5, 32 bins, on a 0.7/0.3 split."""
    train, test = _emb(spark, sf_dir).randomSplit(list(TREE_LIBSVM_SPLIT), seed=TREE_LIBSVM_SEED)
    model = fit("decision_tree", train, **TREE_LIBSVM)
    return model.transform(test).select("vec_id", "label", "prediction")


@query("m_dt_save_load")
def q_m_dt_save_load(spark, sf_dir):
    """K3/K4/M5c (+E4): save the tree, load it, score the test split with the
    loaded model; reports success counts and whether the dumps agree."""
    train, test = _emb(spark, sf_dir).randomSplit(list(TREE_LIBSVM_SPLIT), seed=TREE_LIBSVM_SEED)
    fitted = fit("decision_tree", train, **TREE_LIBSVM)
    loaded, _, _ = tree_save_load(spark, fitted.model)
    same = loaded.toDebugString == fitted.model.toDebugString
    pred = loaded.transform(test.withColumn("features", F.col("features").alias("features", metadata={})))
    return success_rate(pred).withColumn("same_tree", F.lit(same))


@query("m_lr_lbfgs_libsvm")
def q_m_lr_lbfgs_libsvm(spark, sf_dir):
    """M2 (+E3): L-BFGS on LibSVM files, fitted on 0.3 of the rows, accuracy on the rest."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/libsvm-{uuid.uuid4().hex}"
    write_libsvm(_emb(spark, sf_dir), path)
    train, test = read_libsvm(spark, path).randomSplit(list(LBFGS_LIBSVM_SPLIT), seed=LBFGS_LIBSVM_SEED)
    return accuracy(fit("lr_lbfgs", train).transform(test))


@query("m_lr_elasticnet")
def q_m_lr_elasticnet(spark, sf_dir):
    """M3 + E8/E9/E10: elastic-net LR; threshold with the best F-measure and
    AUC, both from the exact curve of its training predictions; predictions on
    all rows."""
    data = embeddings_by_sign(table(spark, sf_dir, "embeddings"))
    f = fit("lr_elasticnet", data, **ELASTIC_NET)
    _, training_auc = exact_summary(f, data)
    out = f.model.transform(data)
    return out.select("vec_id", "label", vector_to_array("probability")[1].alias("score"), "prediction",
                      F.lit(training_auc).alias("summary_auc"))


@query("eval_objective_history")
def q_eval_objective_history(spark, sf_dir):
    """Loss per solver iteration of the elastic-net fit."""
    f = fit("lr_elasticnet", embeddings_by_sign(table(spark, sf_dir, "embeddings")), **ELASTIC_NET)
    return objective_history(spark, f.model)


@query("src_libsvm", oracle="""
SELECT (label < 5)::INT::DOUBLE AS label, list_transform(embedding, lambda x: x::DOUBLE) AS features
FROM embeddings""")
def q_src_libsvm(spark, sf_dir):
    """Embeddings written as LibSVM text (shared checkpoint storage),
    read back with the LibSVM source."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/libsvm-{uuid.uuid4().hex}"
    write_libsvm(_emb(spark, sf_dir), path)
    df = read_libsvm(spark, path)
    return df.select("label", vector_to_array("features").alias("features"))


# ---- J2 --------------------------------------------------------------------------

@query("hashing_tf")
def q_hashing_tf(spark, sf_dir):
    """25,000-bucket hashed term counts of every document."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return hashed_tf(docs, "doc_id", tokenize_spaces("text")).withColumnRenamed("id", "doc_id")


@query("hashing_tf_totals", oracle=r"""
WITH toks AS (
  SELECT doc_id,
         unnest(CASE WHEN regexp_replace(text, ' +$', '') = '' AND text <> '' THEN []::VARCHAR[]
                     ELSE string_split(regexp_replace(text, ' +$', ''), ' ') END) AS term
  FROM documents)
SELECT doc_id, count(*)::DOUBLE AS total, true AS in_range FROM toks GROUP BY doc_id""")
def q_hashing_tf_totals(spark, sf_dir):
    """F5 checked: hashing loses no term and every bucket is in range."""
    inside = F.col("bucket").between(0, NUM_FEATURES - 1)
    return q_hashing_tf(spark, sf_dir).groupBy("doc_id").agg(F.sum("tf").alias("total"), F.every(inside).alias("in_range"))


@query("m_text_classifier")
def q_m_text_classifier(spark, sf_dir):
    """Spam (toxic) vs ham SGD classifier on hashed counts; scores
    every document."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    lab = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    j = docs.join(broadcast_if_small(lab), "doc_id")
    model = train_spam_classifier(j.where("toxic = 1"), j.where("toxic = 0"), "doc_id", "text")
    return model.scorer.score(docs, "doc_id", tokenize_spaces("text"))
