"""Parameter sweeps and cross-grid search.

The SGD learners fit all points of all sweeps and the grid together
(``batched_sgd``): as many passes over the training rows as the longest point
has iterations, and one pass over the validation rows for all evaluations.
A decision tree grows level by level, and what a node becomes does not depend on
the greatest depth: points that differ in it only are one fit of the deepest,
cut at each point's depth, and one pass over the validation rows. For other
learners every point is one fit plus one evaluation. Fits are independent and
run on a small driver-side thread pool. The report is a DataFrame ``(param, value, auc, train_ms)`` instead of a chart.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.operators.batched_sgd import TrainingTable, auc_of_counts, fit_batch, score_counts, training_table
from verdant.operators.features import continuous
from verdant.operators.learners import SGD_KINDS, TREE_DEFAULTS, Fitted, fit, fit_sgd
from verdant.operators.metrics import auc_hard
from verdant.operators.tree_table import cut_predictions

# Sweeps and cross grids of the classic page jobs.
# Each sweep: (parameter varied, {param: values}) with the others held fixed.
TREE_SWEEPS = [
    ("impurity", {"impurity": ["gini", "entropy"], "max_depth": [10], "max_bins": [10]}),
    ("max_depth", {"impurity": ["gini"], "max_depth": [3, 5, 10, 15, 20, 25], "max_bins": [10]}),
    ("max_bins", {"impurity": ["gini"], "max_depth": [10], "max_bins": [3, 5, 10, 50, 100, 200]}),
]
TREE_GRID = {"impurity": ["gini", "entropy"], "max_depth": [3, 5, 10, 15, 20], "max_bins": [3, 5, 10, 50, 100]}

SVM_SWEEPS = [
    ("iterations", {"iterations": [1, 3, 5, 15, 25], "step": [100.0], "reg": [1.0]}),
    ("step", {"iterations": [25], "step": [10.0, 50.0, 100.0, 200.0], "reg": [1.0]}),
    ("reg", {"iterations": [25], "step": [100.0], "reg": [0.01, 0.1, 1.0]}),
]
SVM_GRID = {"iterations": [1, 3, 5, 15, 25], "step": [10.0, 50.0, 100.0, 200.0], "reg": [0.01, 0.1, 1.0]}

LR_SWEEPS = [
    ("iterations", {"iterations": [5, 15, 20, 60, 100], "step": [100.0], "mini_batch": [1.0]}),
    ("step", {"iterations": [100], "step": [10.0, 50.0, 100.0, 200.0], "mini_batch": [1.0]}),
    ("mini_batch", {"iterations": [100], "step": [100.0], "mini_batch": [0.5, 0.8, 1.0]}),
]
LR_GRID = {"iterations": [1, 3, 5, 10], "step": [10.0, 50.0, 100.0], "mini_batch": [0.5, 0.8, 1.0]}

PLANS = {
    "decision_tree": (TREE_SWEEPS, TREE_GRID),
    "svm_sgd": (SVM_SWEEPS, SVM_GRID),
    "lr_sgd": (LR_SWEEPS, LR_GRID),
}


CONCURRENT_FITS = 2         # fits of the other learners at a time


def expand(grid: dict[str, list]) -> list[dict]:
    """Cross product in the nested-loop order of the keys (first key outermost)."""
    keys = list(grid)
    return [dict(zip(keys, vals)) for vals in itertools.product(*(grid[k] for k in keys))]


def evaluate(fitted: Fitted, data: DataFrame) -> float | None:
    """AUC of the hard predictions on ``data`` (one aggregation, one number)."""
    return auc_hard(fitted.transform(data)).first()["auc"]


@dataclass
class GridPoint:
    index: int
    params: dict
    auc: float | None
    train_ms: float


@dataclass
class SearchTables:
    """Training and validation rows of the batched solver, written once for a whole search."""
    train: TrainingTable
    valid: TrainingTable


def search_tables(learner: str, train: DataFrame, valid: DataFrame) -> SearchTables | None:
    return SearchTables(training_table(train), training_table(valid)) if learner in SGD_KINDS else None


def run_points(learner: str, train: DataFrame, valid: DataFrame, points: list[dict],
               parallelism: int = CONCURRENT_FITS, tables: SearchTables | None = None) -> list[GridPoint]:
    """Fit and evaluate every point. ``tables``: the rows already written for the batched solver; other learners run
    ``parallelism`` fits at a time."""
    if learner in SGD_KINDS:
        tables, kind = tables or search_tables(learner, train, valid), SGD_KINDS[learner]
        fits = fit_batch(tables.train, kind, points)
        counts = score_counts(tables.valid, kind, [f.weights for f in fits])
        return [GridPoint(i, p, auc_of_counts(c), f.train_ms) for i, (p, f, c) in enumerate(zip(points, fits, counts, strict=True))]

    if learner == "decision_tree":
        return _tree_points(train, valid, points, parallelism)

    def one(i_p):
        i, p = i_p
        f = fit(learner, train, **p)
        return GridPoint(i, p, evaluate(f, valid), f.train_ms)
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        return list(ex.map(one, enumerate(points)))


def _depth(params: dict) -> int:
    return int(params.get("max_depth", TREE_DEFAULTS["max_depth"]))


def tree_counts(fitted: Fitted, valid: DataFrame, depths: list[int]) -> dict[int, dict]:
    """``{tp, fp, fn, tn}`` of the hard predictions of a fitted tree cut at each depth, from one pass."""
    model = fitted.model
    leaves = model.transform(valid.select("label", continuous("features")), {model.leafCol: "leaf"})
    rows = leaves.groupBy(F.col("leaf").cast("int").alias("leaf"), "label").agg(F.count(F.lit(1)).alias("n")).toArrow()   # two a leaf at most
    leaf, label, n = (rows.column(c).to_numpy() for c in ("leaf", "label", "n"))
    return {d: {name: int(n[(label == y) & (cut[leaf] == p)].sum()) for name, y, p in
                (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0))}
            for d, cut in cut_predictions(valid.sparkSession, model, depths).items()}


def _tree_points(train: DataFrame, valid: DataFrame, points: list[dict], parallelism: int) -> list[GridPoint]:
    """One fit for all points that differ in ``max_depth`` only; their ``train_ms`` is that of the deepest."""
    alike: dict[tuple, list[int]] = {}
    for i, p in enumerate(points):
        alike.setdefault(tuple(sorted((k, v) for k, v in p.items() if k != "max_depth")), []).append(i)
    train, valid = (df.select("label", "features").persist(StorageLevel.MEMORY_AND_DISK) for df in (train, valid))

    def one(members):
        f = fit("decision_tree", train, **max((points[i] for i in members), key=_depth))
        counts = tree_counts(f, valid, [_depth(points[i]) for i in members])
        return [GridPoint(i, points[i], auc_of_counts(counts[_depth(points[i])]), f.train_ms) for i in members]
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
            return sorted((g for found in ex.map(one, alike.values()) for g in found), key=lambda g: g.index)
    finally:
        train.unpersist()
        valid.unpersist()


def pick_best(points: list[GridPoint]) -> GridPoint:
    """Best AUC; ties -> the LAST point in grid order."""
    return max(points, key=lambda g: (float("-inf") if g.auc is None else g.auc, g.index))


def _report(spark: SparkSession, name: str, points: list[GridPoint]) -> DataFrame:
    return spark.createDataFrame([(name, str(g.params[name]), g.auc, float(g.train_ms)) for g in points],
                                 "param string, value string, auc double, train_ms double")


def _sweep_points(sweeps: list[tuple[str, dict]]) -> list[dict]:
    return [p for _, grid in sweeps for p in expand(grid)]


def _sweep_report(spark: SparkSession, sweeps: list[tuple[str, dict]], points: list[GridPoint]) -> DataFrame:
    out, at = None, 0
    for name, grid in sweeps:
        n = len(expand(grid))
        report = _report(spark, name, points[at:at + n])
        out, at = report if out is None else out.unionByName(report), at + n
    return out


def sweep_all(spark: SparkSession, learner: str, train: DataFrame, valid: DataFrame, sweeps: list[tuple[str, dict]],
              parallelism: int = CONCURRENT_FITS, tables: SearchTables | None = None) -> DataFrame:
    """Several sweeps ``(parameter, grid)``, all their points together; one report ``(param, value, auc, train_ms)``."""
    return _sweep_report(spark, sweeps, run_points(learner, train, valid, _sweep_points(sweeps), parallelism, tables))


def sweep(spark: SparkSession, learner: str, train: DataFrame, valid: DataFrame,
          name: str, grid: dict[str, list], parallelism: int = CONCURRENT_FITS, tables: SearchTables | None = None) -> DataFrame:
    """Vary one parameter; report ``(param, value, auc, train_ms)``."""
    return sweep_all(spark, learner, train, valid, [(name, grid)], parallelism, tables)


def refitted(learner: str, train: DataFrame, valid: DataFrame, best: GridPoint, tables: SearchTables | None = None) -> Fitted:
    """The best parameters on train ∪ validation (the corrected refit)."""
    if learner in SGD_KINDS and tables:
        both = TrainingTable(tables.train.rows.unionByName(tables.valid.rows), max(tables.train.width, tables.valid.width))
        return fit_sgd(learner, train, both, **best.params)
    both = train.unionByName(valid)
    return fit_sgd(learner, both, **best.params) if learner in SGD_KINDS else fit(learner, both, **best.params)


def cross_grid(learner: str, train: DataFrame, valid: DataFrame, grid: dict[str, list],
               parallelism: int = CONCURRENT_FITS, refit: bool = True, tables: SearchTables | None = None) -> tuple[Fitted | None, GridPoint, list[GridPoint]]:
    """Evaluate the full cross grid on ``valid``; refit the best
    parameters on train ∪ validation."""
    tables = tables or search_tables(learner, train, valid)
    pts = run_points(learner, train, valid, expand(grid), parallelism, tables)
    best = pick_best(pts)
    return refitted(learner, train, valid, best, tables) if refit else None, best, pts


def tune(spark: SparkSession, learner: str, train: DataFrame, valid: DataFrame,
         sweeps=None, grid=None, parallelism: int = CONCURRENT_FITS,
         on_sweep: Callable[[DataFrame], None] | None = None):
    """G6 tuning branch: all sweeps and the cross grid, in one search, then the refit.
    Returns ``(model, best_point, sweep_report)``."""
    default_sweeps, default_grid = PLANS[learner]
    sweeps = default_sweeps if sweeps is None else sweeps
    grid = default_grid if grid is None else grid
    tables = search_tables(learner, train, valid)
    swept = _sweep_points(sweeps)
    points = run_points(learner, train, valid, swept + expand(grid), parallelism, tables)
    report = _sweep_report(spark, sweeps, points[:len(swept)])
    if on_sweep:
        on_sweep(report)
    best = pick_best([replace(g, index=i) for i, g in enumerate(points[len(swept):])])
    return refitted(learner, train, valid, best, tables), best, report
