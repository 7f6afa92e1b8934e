"""Registered queries of running the classic jobs as services: saved pipelines, rejected input, counts that ride along,
tree tables, previews, seeded splits and URIs (K5, G6, P6, A1, M5c, M7, O3, O4, R2, S9)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from verdant.functions.text import strip_quotes
from verdant.operators.features import category_dictionary, features_array, fit_features, parse_pages
from verdant.operators.intake import observed_intake, split_rejects
from verdant.operators.learners import fit
from verdant.operators.pipeline import page_pipeline, score_saved
from verdant.operators.split import random_split
from verdant.operators.tree_table import NODES, node_table, score_nodes
from verdant.plans.feature_queries import NUMERICS, SQL_PARSED, SQL_RAW_TRAIN, _clean_num_sql
from verdant.plans.jobs import embeddings_labelled, run_page_classification
from verdant.plans.model_queries import LBFGS_LIBSVM_SEED, TREE_LIBSVM
from verdant.plans.registry import query
from verdant.session import scratch_path, written
from verdant.sources.pages import labelled_page_rows, unlabelled_page_rows
from verdant.sources.sinks import first_rows, save_model
from verdant.sources.tables import spread, table

# ---- K5, G6: saved pipelines -----------------------------------------------------


@query("page_features_saved", oracle=f"""
WITH {SQL_RAW_TRAIN}, {SQL_PARSED}
SELECT url, f AS features FROM feat""")
def q_page_features_saved(spark, sf_dir):
    """K5: the fitted feature steps saved, loaded and applied to all labelled pages."""
    parsed = written(parse_pages(labelled_page_rows(spark, sf_dir), has_label=True), "pages")
    path = scratch_path(spark, "feature-pipeline")
    save_model(page_pipeline(spark, fit_features(parsed, NUMERICS, scale=False)), path)
    return PipelineModel.load(path).transform(parsed).select("url", features_array("features").alias("features"))


@query("page_classification_saved")
def q_page_classification_saved(spark, sf_dir):
    """K5 + G6: the flagship's feature steps and model saved as one pipeline, loaded, and used to score every page."""
    score_raw = unlabelled_page_rows(spark, sf_dir)
    run = run_page_classification(spark, labelled_page_rows(spark, sf_dir), score_raw, measure=False)
    run.unpersist()
    path = scratch_path(spark, "page-pipeline")
    save_model(page_pipeline(spark, run.feature_model, run.model), path)
    return score_saved(path, parse_pages(score_raw, has_label=False))


# ---- P6, A1: rejected input, counts that ride along ---------------------------------

def dirty_page_rows(spark, sf_dir):
    """Labelled pages, of which some have a source's name instead of a count, an empty count, or a label that is none."""
    raw, i = labelled_page_rows(spark, sf_dir), strip_quotes("urlid").cast("long")
    return (raw.withColumn("x_chars", F.when(i % 7 == 0, F.col("boilerplate")).otherwise(F.col("x_chars")))
            .withColumn("x_tokens", F.when(i % 11 == 0, F.lit('""')).when(i % 11 == 1, F.lit('"?"')).otherwise(F.col("x_tokens")))
            .withColumn("label", F.when(i % 13 == 0, F.lit('"2"')).otherwise(F.col("label"))))


SQL_DIRTY = f"""{SQL_RAW_TRAIN},
numbered AS (SELECT *, replace(urlid, '"', '')::BIGINT AS i FROM raw),
dirty AS (SELECT * EXCLUDE (i) REPLACE (
    CASE WHEN i % 7 = 0 THEN boilerplate ELSE x_chars END AS x_chars,
    CASE WHEN i % 11 = 0 THEN '""' WHEN i % 11 = 1 THEN '"?"' ELSE x_tokens END AS x_tokens,
    CASE WHEN i % 13 = 0 THEN '"2"' ELSE label END AS label) FROM numbered),
fields AS (SELECT url, unnest([{', '.join(f"{{'field': '{c}', 'raw': {c}}}" for c in (*NUMERICS, 'label'))}], recursive := true) FROM dirty),
rejects AS (SELECT replace(url, '"', '') AS url, field, raw,
    CASE WHEN field = 'label' THEN 'not 0 or 1' ELSE 'not a number' END AS reason FROM fields
  WHERE CASE WHEN field = 'label' THEN coalesce(try_cast(replace(raw, '"', '') AS DOUBLE) NOT IN (0, 1), true)
        ELSE replace(raw, '"', '') <> '?' AND try_cast(replace(raw, '"', '') AS DOUBLE) IS NULL END)"""


@query("page_rejects", oracle=f"WITH {SQL_DIRTY} SELECT * FROM rejects")
def q_page_rejects(spark, sf_dir):
    """Every field that can't be read, with its row's url, raw value and reason."""
    return split_rejects(dirty_page_rows(spark, sf_dir), has_label=True)[1]


@query("page_accepted", oracle=f"""
WITH {SQL_DIRTY}
SELECT replace(url, '"', '') AS url, category, {', '.join(_clean_num_sql(c) + ' AS ' + c for c in NUMERICS)},
       replace(label, '"', '')::DOUBLE AS label
FROM dirty WHERE replace(url, '"', '') NOT IN (SELECT url FROM rejects)""")
def q_page_accepted(spark, sf_dir):
    """The typed rows whose fields can all be read."""
    return split_rejects(dirty_page_rows(spark, sf_dir), has_label=True)[0]


@query("page_run_observed", oracle=f"""
WITH {SQL_DIRTY},
known AS (SELECT DISTINCT category FROM raw WHERE category <> '"es"'),
good AS (SELECT category FROM dirty WHERE replace(url, '"', '') NOT IN (SELECT url FROM rejects))
SELECT (SELECT count(*) FROM dirty) AS rows, (SELECT count(DISTINCT url) FROM rejects) AS bad_rows,
       (SELECT count(*) FROM rejects) AS bad_fields,
       (SELECT count(*) FROM good WHERE category NOT IN (SELECT category FROM known)) AS unseen_categories""")
def q_page_run_observed(spark, sf_dir):
    """A1: rows, bad rows, bad fields and unseen categories, counted while the parsed rows are written. One language
    is left out of the dictionary. The counting runs in a session of its own (see ``observed``)."""
    result, spark = spark, spark.newSession()
    known = labelled_page_rows(spark, sf_dir).select("category").where(F.col("category") != '"es"')
    rows, seen = observed_intake(dirty_page_rows(spark, sf_dir), written(category_dictionary(known), "categories"), has_label=True)
    written(rows, "observed-pages")
    counts = {k: int(v) for s in seen for k, v in s.get.items()}
    return result.createDataFrame([counts], "rows bigint, bad_rows bigint, bad_fields bigint, unseen_categories bigint")


# ---- M5c, M7: trees as tables ---------------------------------------------------------

# A tree on the numeric page fields.
TREE_NODES = [(0, 0, 1500.0, 1, 2, 0.0), (1, 4, 60.0, 3, 4, 0.0), (2, 3, 40.0, 5, 6, 1.0),
              (3, -1, None, -1, -1, 0.0), (4, -1, None, -1, -1, 1.0), (5, 2, 300.0, 7, 8, 1.0), (6, -1, None, -1, -1, 1.0),
              (7, -1, None, -1, -1, 0.0), (8, -1, None, -1, -1, 1.0)]


@query("tree_table_score", oracle=f"""
WITH {SQL_RAW_TRAIN}, {SQL_PARSED},
leaves AS (SELECT url, CASE WHEN x_chars <= 1500 THEN CASE WHEN x_distinct <= 60 THEN 3 ELSE 4 END
    WHEN x_punct <= 40 THEN CASE WHEN x_tokens <= 300 THEN 7 ELSE 8 END ELSE 6 END AS leaf FROM parsed)
SELECT url, leaf::INTEGER AS leaf, CASE WHEN leaf IN (3, 7) THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS prediction FROM leaves""")
def q_tree_table_score(spark, sf_dir):
    """M7 by a tree that is given as a node table: leaf and prediction of every labelled page."""
    parsed = parse_pages(labelled_page_rows(spark, sf_dir), has_label=True)
    return score_nodes(parsed, spark.createDataFrame(TREE_NODES, NODES), F.array(*NUMERICS)).select("url", "leaf", "prediction")


@query("m_dt_nodes")
def q_m_dt_nodes(spark, sf_dir):
    """The node table of a tree fitted on the embeddings."""
    return node_table(spark, fit("decision_tree", embeddings_labelled(table(spark, sf_dir, "embeddings")), **TREE_LIBSVM).model)


@query("m_dt_node_scores", oracle="SELECT count(*) AS vectors, count(*) AS same FROM embeddings")
def q_m_dt_node_scores(spark, sf_dir):
    """M5c + M7: vectors that a fitted tree and its node table score alike (all)."""
    data = embeddings_labelled(table(spark, sf_dir, "embeddings"))
    model = fit("decision_tree", data, **TREE_LIBSVM).model
    both = score_nodes(model.transform(data).withColumnRenamed("prediction", "by_model"), node_table(spark, model))
    return both.agg(F.count("*").alias("vectors"), F.count_if(F.col("by_model") == F.col("prediction")).alias("same"))


# ---- O3, O4, R2, S9 -----------------------------------------------------------------------

# Lengths of the classic jobs' previews, and the weights of their seeded split.
PREVIEW_ROWS, REPORT_ROWS = 20, 10
SEEDED_SPLIT = (0.6, 0.4)


@query("preview_pages", oracle=f"""
WITH {SQL_RAW_TRAIN}, {SQL_PARSED}
SELECT url, category, label FROM parsed ORDER BY url LIMIT {PREVIEW_ROWS}""")
def q_preview_pages(spark, sf_dir):
    """The first twenty parsed pages by url, a distributed top-k."""
    return first_rows(parse_pages(labelled_page_rows(spark, sf_dir), has_label=True).select("url", "category", "label"), PREVIEW_ROWS, "url")


@query("preview_longest", oracle=f"""
SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC NULLS LAST, doc_id LIMIT {REPORT_ROWS}""")
def q_preview_longest(spark, sf_dir):
    """O3: the ten longest documents, ties by id."""
    return first_rows(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), REPORT_ROWS, F.desc_nulls_last("n_chars"), "doc_id")


@query("random_split_seeded", oracle="""
SELECT count(*) AS total, 0::BIGINT AS in_both, 0::BIGINT AS in_none, true AS repeatable FROM labels""")
def q_random_split_seeded(spark, sf_dir):
    """R2: Spark's seeded sampler on a written table: the parts are disjoint, cover all rows, and a second split with the
    same seed gives the same parts."""
    rows = written(table(spark, sf_dir, "labels").select("doc_id"), "labels")
    split = lambda: random_split(rows, SEEDED_SPLIT, LBFGS_LIBSVM_SEED)
    (a, b), (a2, _) = split(), split()
    tagged = (rows.withColumn("part", F.lit(0)).unionByName(a.withColumn("part", F.lit(1))).unionByName(b.withColumn("part", F.lit(2)))
              .unionByName(a2.withColumn("part", F.lit(3))))
    per_row = tagged.groupBy("doc_id").agg(*[F.count_if(F.col("part") == k).alias(f"p{k}") for k in range(4)])
    return per_row.agg(F.sum("p0").alias("total"), F.count_if((F.col("p1") > 0) & (F.col("p2") > 0)).alias("in_both"),
                       F.coalesce(F.sum(F.greatest(F.col("p0") - F.col("p1") - F.col("p2"), F.lit(0))), F.lit(0)).alias("in_none"),
                       F.coalesce(F.every(F.col("p1") == F.col("p3")), F.lit(True)).alias("repeatable"))


@query("src_uri", oracle="SELECT doc_id, length(text)::BIGINT AS n FROM documents")
def q_src_uri(spark, sf_dir):
    """A table read by a full URI (``file:`` if the path names no scheme)."""
    uri = sf_dir if "://" in sf_dir or sf_dir.startswith("file:") else f"file://{sf_dir}"
    docs = spread(table(spark, uri, "documents").select("doc_id", "text"), "doc_id")
    return docs.select("doc_id", F.length("text").cast("bigint").alias("n"))
