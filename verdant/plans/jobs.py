"""End-to-end jobs (G6, J2-J5) built from the operators.

Each job takes DataFrames (so any source works: TSV files, LibSVM files,
tables) and returns DataFrames; nothing is printed or collected beyond single
numbers (metrics) and model parameters.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.functions.text import tokenize_spaces
from verdant.operators.features import fit_features, fit_scaler, page_layout, parse_pages
from verdant.operators.hashed_text import fit_text_lr_sgd
from verdant.operators.learners import (LR_SGD_DEFAULTS, SVM_SGD_DEFAULTS, TREE_DEFAULTS, Fitted,
                                        fit)
from verdant.operators.metrics import auc, best_threshold, describe_prediction, f_measure_by_threshold, score_curve
from verdant.operators.split import split_label
from verdant.operators.tune import CONCURRENT_FITS, evaluate, tune
from verdant.session import ensure_checkpoint_dir, written
from verdant.sources.flags import FLAG_FEATURES, parse_flags

DEFAULTS = {"lr_sgd": LR_SGD_DEFAULTS, "svm_sgd": SVM_SGD_DEFAULTS, "decision_tree": TREE_DEFAULTS}
SCALED = {"lr_sgd": True, "svm_sgd": True, "decision_tree": False,
          "lr_lbfgs": True, "linear_svc": True}


@dataclass
class ClassificationRun:
    scored: DataFrame
    model: Fitted
    validation_auc: float | None
    test_auc: float | None
    best_params: dict
    sweep_report: DataFrame | None = None
    parts: dict = field(default_factory=dict)
    feature_model: Any = None

    def unpersist(self):
        """Release what was kept for training. ``scored`` does not depend on it."""
        release(self.parts)


def release(parts: dict) -> None:
    for p in parts.values():
        p.unpersist()


def prepare_pages(train_raw: DataFrame, scale: bool, weights=(0.8, 0.1, 0.1),
                  on_bad: str = "fail", unseen: str = "error"):
    """Parse, split by a stable key hash, fit the feature model, and keep the
    parsed rows (re-used by every fit and evaluation)."""
    parsed = parse_pages(train_raw, has_label=True, on_bad=on_bad)
    numerics = [c for c in parsed.columns if c not in ("url", "category", "label")]
    # Parsed rows are computed once (text features are the costly part) and
    # kept; every fit and evaluation below reads the cached rows.
    tagged = (parsed.withColumn("_split", split_label(F.xxhash64("url"), weights))
              .persist(StorageLevel.MEMORY_AND_DISK))
    # Dictionary from every labelled row (no labels involved); scaler from
    # the training part only.
    fm = fit_features(tagged, numerics, scale, unseen, scale_rows=tagged.where(F.col("_split") == "train"))
    feats = fm.transform(tagged).select("url", "label", "features", "_split")
    parts = {name: feats.where(F.col("_split") == name).drop("_split")
             for name in ("train", "validation", "test")}
    parts["_rows"] = tagged
    return parts, fm, numerics


def score_pages(score_raw: DataFrame, fm, model: Fitted, refit_scaler: bool = False,
                on_bad: str = "fail") -> DataFrame:
    """Score every unlabelled page: ``(url, score, prediction, description)``.

    Features use the training feature model (its dictionary and scaler);
    ``refit_scaler=True`` instead re-fits the scaler on the scoring rows."""
    page_layout(score_raw, has_label=False)
    parsed = parse_pages(score_raw, has_label=False, on_bad=on_bad)
    if refit_scaler and fm.scaler is not None:
        raw = fm.assembled(parsed)
        feats = fit_scaler(raw).transform(raw)
    else:
        feats = fm.transform(parsed)
    out = model.transform(feats.select("url", "features"))
    return describe_prediction(out.select("url", "score", "prediction"))


def run_page_classification(spark: SparkSession, train_raw: DataFrame, score_raw: DataFrame,
                            learner: str = "lr_sgd", tune_params: bool = False,
                            params: dict | None = None, parallelism: int = CONCURRENT_FITS,
                            refit_scaler: bool = False, sweeps=None, grid=None, on_bad: str = "fail",
                            unseen: str = "error", measure: bool = True) -> ClassificationRun:
    """Prepare -> train (default parameters, or sweeps + cross grid) ->
    validation and test AUC (unless ``measure`` is false) -> score the
    unlabelled pages. ``on_bad`` (fail, zero, null) says what a field that is
    no number becomes, ``unseen`` (error, keep, drop) what a page of an unknown
    category does."""
    scale = SCALED.get(learner, True)
    parts, fm, _ = prepare_pages(train_raw, scale, on_bad=on_bad, unseen=unseen)
    train, valid, test = parts["train"], parts["validation"], parts["test"]
    report = None
    if tune_params:
        model, best, report = tune(spark, learner, train, valid, sweeps, grid, parallelism)
        best_params = best.params
    else:
        best_params = dict(DEFAULTS.get(learner, {}), **(params or {}))
        model = fit(learner, train, **best_params)
    v_auc = evaluate(model, valid) if measure else None
    t_auc = evaluate(model, test) if measure else None
    scored = score_pages(score_raw, fm, model, refit_scaler, on_bad)
    return ClassificationRun(scored, model, v_auc, t_auc, best_params, report, parts, fm)


# ---- J3: LibSVM decision tree --------------------------------------------------

def libsvm_frame(df: DataFrame, label: Any, array_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(*keep, label double, features vector)`` from an array column, the
    shape the LibSVM reader produces."""
    return df.select(*keep, label.cast("double").alias("label"),
                     array_to_vector(F.col(array_col)).alias("features"))


def embeddings_by_sign(emb: DataFrame) -> DataFrame:
    """Stand-in data that an elastic-net penalty does not flatten: class = the first component is positive."""
    return libsvm_frame(emb, F.col("embedding")[0] > 0, "embedding", keep=("vec_id",))


def embeddings_labelled(emb: DataFrame) -> DataFrame:
    """Stand-in LibSVM data: embeddings, class = (label < 5)."""
    return libsvm_frame(emb, (F.col("label") < 5), "embedding", keep=("vec_id",))


def tree_save_load(spark: SparkSession, model, path: str | None = None, overwrite: bool = False):
    """K3/K4: save the fitted tree under the checkpoint directory (shared
    storage), load it back; returns ``(loaded, path, message)``. An existing
    path yields a message and no model (what lies there is another one) unless
    ``overwrite``."""
    base = ensure_checkpoint_dir(spark)
    path = path or f"{base.rstrip('/')}/models/tree-{uuid.uuid4().hex}"
    w = model.write()
    if overwrite:
        w = w.overwrite()
    try:
        w.save(path)
    except Exception as e:  # noqa: BLE001 - reported, as the classic job does
        if "already exists" not in str(e):
            raise
        return None, path, "output path already exists; remove it first"
    return DecisionTreeClassificationModel.load(path), path, "saved"


# ---- J4: elastic-net logistic regression summary -----------------------------

def exact_summary(fitted: Fitted, data: DataFrame) -> tuple[float, float]:
    """E8-E10 from the exact curve of the predictions on ``data``: sets the
    model's threshold to the one with the best F-measure; returns it and the AUC."""
    curve = score_curve(fitted.transform(data).select("score", "label"))
    t = best_threshold(f_measure_by_threshold(curve)).first()["threshold"]
    fitted.model.setThreshold(t)
    return t, auc(curve).first()["auc"]


def objective_history(spark: SparkSession, model) -> DataFrame:
    """``(iteration, loss)`` of the solver (bounded by maxIter)."""
    h = list(model.summary.objectiveHistory)
    return spark.createDataFrame([(i, float(x)) for i, x in enumerate(h)], "iteration int, loss double")


# ---- J5: flag records ---------------------------------------------------------

def flag_points(lines: DataFrame) -> DataFrame:
    rec = parse_flags(lines)
    return VectorAssembler(inputCols=list(FLAG_FEATURES), outputCol="features").transform(rec) \
        .select("barcode", "label", "features")


# ---- J2: spam classifier ---------------------------------------------------------

def train_spam_classifier(spam: DataFrame, ham: DataFrame, id_col: str, text_col: str,
                          **params) -> Fitted:
    """Spam (label 1) ∪ ham (label 0) -> space tokens -> hashed counts ->
    SGD logistic regression."""
    data = (spam.select(id_col, text_col).withColumn("label", F.lit(1.0))
            .unionByName(ham.select(id_col, text_col).withColumn("label", F.lit(0.0))))
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return fit_text_lr_sgd(data, id_col, tokenize_spaces(F.col(text_col)), **params)
    finally:
        data.unpersist()


# ---- J6: word count over text files ---------------------------------------------

def run_word_count(spark: SparkSession, input_path: str, stop_path: str | None = None,
                   counts_out: str | None = None, top_out: str | None = None, k: int = 100):
    """S3 -> T1 -> P2 -> A2 -> K1, then O1/O2 -> K2. The counts are written once
    because both outputs read them. Returns ``(counts, top)``."""
    from verdant.operators.wordcount import stop_words_frame, top_words, word_count
    from verdant.sources.sinks import save_ordered_text, save_table

    lines = spark.read.text(input_path)
    stop = stop_words_frame(spark, stop_path) if stop_path else None
    counts = written(word_count(lines, stop), "word-counts")
    if counts_out:
        save_table(counts, counts_out, fmt="csv")
    top = top_words(counts, k)
    if top_out:
        save_ordered_text(top, top_out)
    return counts, top
