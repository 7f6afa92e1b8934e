"""End-to-end page classification: default and tuned branches."""

from verdant.plans.jobs import run_page_classification
from verdant.sources.pages import labelled_page_rows, unlabelled_page_rows

SF = "/root/testdata/sf0.001"


def test_tuned_branch_runs_sweeps_grid_and_refit(spark):
    sweeps = [("iterations", {"iterations": [1, 3], "step": [10.0], "mini_batch": [1.0]})]
    grid = {"iterations": [1, 3], "step": [10.0, 50.0], "mini_batch": [1.0]}
    run = run_page_classification(spark, labelled_page_rows(spark, SF), unlabelled_page_rows(spark, SF),
                                  learner="lr_sgd", tune_params=True, sweeps=sweeps, grid=grid)
    rep = run.sweep_report.collect()
    assert [(r.param, r.value) for r in rep] == [("iterations", "1"), ("iterations", "3")]
    assert run.best_params in [{"iterations": i, "step": s, "mini_batch": 1.0}
                               for i in (1, 3) for s in (10.0, 50.0)]
    scored = run.scored.collect()
    assert len(scored) == 50 and {r.prediction for r in scored} <= {0.0, 1.0}
    run.unpersist()


def test_tree_branch_and_refit_scaler(spark):
    tr, sc = labelled_page_rows(spark, SF), unlabelled_page_rows(spark, SF)
    tree = run_page_classification(spark, tr, sc, learner="decision_tree")
    assert tree.scored.count() == 50
    refit = run_page_classification(spark, tr, sc, learner="lr_sgd", refit_scaler=True)
    assert refit.scored.count() == 50
