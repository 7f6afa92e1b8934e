"""Registered evaluation queries (E1-E9, P3, P7, P8, M7 scoring, G2 rule).

Scores come from fixed, data-derived scorers so that the metrics have an
exact SQL twin: documents get ``score = (n_chars mod 97) / 96`` against the
quality label; embeddings get a fixed linear model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.functions.vectors import dot_fixed_weights
from verdant.operators.metrics import (accuracy, apply_threshold, auc, auc_hard, best_of_grid,
                                       best_threshold, describe_prediction, f_measure_by_threshold,
                                       grid_auc_hard, prediction_report, roc_curve, score_curve,
                                       success_rate)
from verdant.plans.feature_queries import SQL_RAW_PAGES
from verdant.operators.features import parse_pages
from verdant.plans.registry import query
from verdant.sources.pages import unlabelled_page_rows
from verdant.sources.tables import table

HARD_THRESHOLD = 0.5
# The threshold grid searched by best_of_grid.
GRID = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]


def scored_documents(spark, sf_dir) -> DataFrame:
    """``(doc_id, score, label)`` for every labelled document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(lab, "doc_id").select(
        "doc_id", ((F.col("n_chars") % 97).cast("double") / F.lit(96.0)).alias("score"),
        F.col("quality").cast("double").alias("label"))


def hard_predictions(spark, sf_dir) -> DataFrame:
    return apply_threshold(scored_documents(spark, sf_dir), HARD_THRESHOLD)


SQL_SCORED = """
scored AS (
  SELECT d.doc_id, (d.n_chars % 97)::DOUBLE / 96.0::DOUBLE AS score, l.quality::DOUBLE AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
),
hard AS (SELECT *, (score >= 0.5)::INT::DOUBLE AS prediction FROM scored)"""

SQL_CURVE = SQL_SCORED + """,
g AS (SELECT score, sum(label::BIGINT)::BIGINT AS pos, sum(1 - label::BIGINT)::BIGINT AS neg
      FROM scored GROUP BY score),
c AS (SELECT score, pos, neg,
             sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)::BIGINT AS tp,
             sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)::BIGINT AS fp
      FROM g),
t AS (SELECT sum(pos)::BIGINT AS P, sum(neg)::BIGINT AS N FROM g)"""


def _curve(spark, sf_dir):
    return score_curve(scored_documents(spark, sf_dir))


@query("eval_roc", oracle=f"""
WITH {SQL_CURVE}
SELECT score AS threshold, fp::DOUBLE / N::DOUBLE AS fpr, tp::DOUBLE / P::DOUBLE AS tpr FROM c, t
UNION ALL SELECT NULL::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
UNION ALL SELECT NULL::DOUBLE, 1.0::DOUBLE, 1.0::DOUBLE""")
def q_eval_roc(spark, sf_dir):
    """E5: exact ROC curve over every distinct score."""
    return roc_curve(_curve(spark, sf_dir))


@query("eval_auc", oracle=f"""
WITH {SQL_CURVE}
SELECT CASE WHEN P > 0 AND N > 0 THEN
         (SELECT sum(neg::HUGEINT * (2 * tp - pos)) FROM c)::DOUBLE / (2.0::DOUBLE * P::DOUBLE * N::DOUBLE)
       END AS auc
FROM t""")
def q_eval_auc(spark, sf_dir):
    """Area under the ROC of raw scores."""
    return auc(_curve(spark, sf_dir))


@query("eval_f_by_threshold", oracle=f"""
WITH {SQL_CURVE}
SELECT score AS threshold, (2.0::DOUBLE * tp::DOUBLE) / (P::DOUBLE + tp::DOUBLE + fp::DOUBLE) AS f_measure,
       tp::DOUBLE / (tp::DOUBLE + fp::DOUBLE) AS precision,
       CASE WHEN P > 0 THEN tp::DOUBLE / P::DOUBLE END AS recall
FROM c, t""")
def q_eval_f_by_threshold(spark, sf_dir):
    """F1, precision and recall at every distinct score."""
    return f_measure_by_threshold(_curve(spark, sf_dir))


SQL_BEST = f"""
WITH {SQL_CURVE},
f AS (SELECT score AS threshold, (2.0::DOUBLE * tp::DOUBLE) / (P::DOUBLE + tp::DOUBLE + fp::DOUBLE) AS f_measure
      FROM c, t)
SELECT threshold, f_measure FROM f ORDER BY f_measure DESC, threshold DESC LIMIT 1"""


@query("eval_best_threshold", oracle=SQL_BEST)
def q_eval_best_threshold(spark, sf_dir):
    """E8 (+A4, P12): threshold of maximal F1; ties -> highest threshold."""
    return best_threshold(f_measure_by_threshold(_curve(spark, sf_dir)))


@query("apply_threshold", oracle=f"""
WITH {SQL_CURVE},
f AS (SELECT score AS threshold, (2.0::DOUBLE * tp::DOUBLE) / (P::DOUBLE + tp::DOUBLE + fp::DOUBLE) AS f_measure
      FROM c, t),
best AS (SELECT threshold FROM f ORDER BY f_measure DESC, threshold DESC LIMIT 1)
SELECT doc_id, score, label, (score >= (SELECT threshold FROM best))::INT::DOUBLE AS prediction FROM scored""")
def q_apply_threshold(spark, sf_dir):
    """Re-classify every row with the best-F1 threshold; the threshold is
    a one-row scalar subquery of the same plan, not a driver round trip."""
    scored = scored_documents(spark, sf_dir)
    best = best_threshold(f_measure_by_threshold(score_curve(scored)))
    return apply_threshold(scored, best.select("threshold").scalar())


@query("eval_auc_hard", oracle=f"""
WITH {SQL_SCORED},
c AS (SELECT sum((prediction = 1 AND label = 1)::BIGINT) AS tp, sum((prediction = 1 AND label = 0)::BIGINT) AS fp,
             sum((prediction = 0 AND label = 0)::BIGINT) AS tn, sum((prediction = 0 AND label = 1)::BIGINT) AS fn
      FROM hard)
SELECT CASE WHEN tp + fn > 0 AND fp + tn > 0 THEN
         (tp::DOUBLE * (fp + tn)::DOUBLE + tn::DOUBLE * (tp + fn)::DOUBLE)
         / (2.0::DOUBLE * (tp + fn)::DOUBLE * (fp + tn)::DOUBLE) END AS auc
FROM c""")
def q_eval_auc_hard(spark, sf_dir):
    """AUC of hard predictions (balanced accuracy)."""
    return auc_hard(hard_predictions(spark, sf_dir))


@query("eval_accuracy", oracle=f"""
WITH {SQL_SCORED}
SELECT sum((prediction = label)::BIGINT)::DOUBLE / count(*)::DOUBLE AS accuracy FROM hard""")
def q_eval_accuracy(spark, sf_dir):
    """Accuracy of hard predictions."""
    return accuracy(hard_predictions(spark, sf_dir))


@query("eval_success_rate", oracle=f"""
WITH {SQL_SCORED}
SELECT sum((prediction = label)::BIGINT)::BIGINT AS success, count(*)::BIGINT AS total,
       sum((prediction = label)::BIGINT)::DOUBLE / count(*)::DOUBLE AS rate FROM hard""")
def q_eval_success_rate(spark, sf_dir):
    """E4 + P3: success count, total and rate."""
    return success_rate(hard_predictions(spark, sf_dir))


@query("prediction_report", oracle=f"""
WITH {SQL_SCORED}
SELECT doc_id, score, label, prediction,
       CASE WHEN prediction = label THEN 'correct' ELSE 'wrong' END AS result FROM hard""")
def q_prediction_report(spark, sf_dir):
    """P8 (+E11): every prediction with a correct/wrong flag."""
    return prediction_report(hard_predictions(spark, sf_dir))


@query("best_of_grid", oracle=f"""
WITH {SQL_SCORED},
grid AS (SELECT i - 1 AS grid_index, t AS threshold
         FROM (SELECT unnest(range(1, {len(GRID) + 1})) AS i,
                      unnest([{', '.join(f'{t}::DOUBLE' for t in GRID)}]) AS t)),
cnt AS (
  SELECT g.grid_index, g.threshold,
         sum(s.label::BIGINT * (s.score >= g.threshold)::BIGINT) AS tp,
         sum((1 - s.label::BIGINT) * (s.score >= g.threshold)::BIGINT) AS fp,
         sum(s.label::BIGINT) AS P, sum(1 - s.label::BIGINT) AS N
  FROM grid g, scored s GROUP BY g.grid_index, g.threshold),
a AS (SELECT grid_index::INTEGER AS grid_index, threshold,
             CASE WHEN P > 0 AND N > 0 THEN (tp::DOUBLE * N::DOUBLE + (N - fp)::DOUBLE * P::DOUBLE)
                  / (2.0::DOUBLE * P::DOUBLE * N::DOUBLE) END AS auc FROM cnt)
SELECT * FROM a ORDER BY auc DESC, grid_index DESC LIMIT 1""")
def q_best_of_grid(spark, sf_dir):
    """G2 selection rule on a threshold grid evaluated in one scan; ties ->
    last grid point."""
    return best_of_grid(grid_auc_hard(scored_documents(spark, sf_dir), GRID))


@query("linear_score", oracle="""
SELECT vec_id, round(list_sum(list_transform(range(1, 65),
                 lambda i: embedding[i]::DOUBLE * (i::DOUBLE / 64.0::DOUBLE))), 6) + 0.0 AS score,
       label::DOUBLE AS label
FROM embeddings""")
def q_linear_score(spark, sf_dir):
    """M7 in SQL form: a fixed linear model scored as a dot product inside
    the JVM (no UDF), for every embedding."""
    emb = table(spark, sf_dir, "embeddings")
    w = [(i + 1) / 64.0 for i in range(64)]
    return emb.select("vec_id", (F.round(dot_fixed_weights("embedding", w), 6) + F.lit(0.0)).alias("score"),
                      F.col("label").cast("double").alias("label"))


@query("score_describe", oracle=f"""
WITH {SQL_RAW_PAGES},
p AS (SELECT replace(url, '"', '') AS url,
             CASE WHEN replace(x_tokens, '"', '') = '?' THEN 0.0 ELSE replace(x_tokens, '"', '')::DOUBLE END AS x_tokens
      FROM praw)
SELECT url, (x_tokens >= 300)::INT::DOUBLE AS prediction,
       CASE WHEN x_tokens >= 300 THEN 'evergreen' ELSE 'ephemeral' END AS description
FROM p""")
def q_score_describe(spark, sf_dir):
    """Class text for each scored page (fixed rule: >= 300 tokens)."""
    pages = parse_pages(unlabelled_page_rows(spark, sf_dir), has_label=False)
    pred = pages.select("url", (F.col("x_tokens") >= 300).cast("double").alias("prediction"))
    return describe_prediction(pred)
