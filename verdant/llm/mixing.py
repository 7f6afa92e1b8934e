"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed point on the hash line, the md5 of its id. A source's
budget is a threshold on that line: documents below it are taken. Budgets are
nested, since a larger one only moves the threshold up. The threshold is found
without sorting a source: sizes are summed by (source, first three hex digits),
the bucket in which the running sum meets the budget is the boundary bucket, and
only that bucket is refined, by its next three digits and then by its documents.

Defined results: null text has size 0; the null source is a source of its own
and ranks last; documents with the same id (repeated rows, null ids) share one
point and are taken together; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.llm.common import n_words, whole_row, written

WEIGHTS = (5, 2, 1)
DIGITS = 3              # hex digits of a histogram level: 4,096 buckets
LEVELS = 2              # histogram levels before documents are looked at
BROADCAST_SOURCES = 50_000   # thresholds of at most so many sources are broadcast


def _source_key(source: Column) -> list[Column]:
    return [source.isNull().alias("no_source"), F.coalesce(source, F.lit("")).alias("src")]


def hash_point(doc_id: Column) -> Column:
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``(no_source, src, source_size, target)`` from rows ``(no_source, src, size)``.

    Sources rank by code point, null last, and weigh ``weights`` in turn. They
    share ``share`` times all sizes; no target exceeds ``cap`` times its source,
    and the excess goes to the others by weight. A source is at its cap exactly
    if, taken in ascending order of cap per weight, its cap is at most its share
    of what the sources before it have left. One row per source is ranked."""
    per = sized.groupBy("no_source", "src").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy("no_source", "src")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("weight", F.element_at(turn, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    most = F.lit(float(cap)) * F.col("source_size")
    up = Window.orderBy(most / F.col("weight"), "no_source", "src")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    after = up.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    per = (per.withColumn("left", F.lit(float(share)) * F.sum("source_size").over(everything)
                          - F.coalesce(F.sum(most).over(before), F.lit(0.0)))
              .withColumn("rest_weight", F.sum("weight").over(after))
              .withColumn("capped", most * F.col("rest_weight") <= F.col("weight") * F.col("left")))
    free = F.when(~F.col("capped"), F.struct(F.col("rest_weight").alias("w"), F.col("left").alias("l")))
    per = per.withColumn("level", F.max(free).over(everything))
    return per.select("no_source", "src", "source_size",
                      F.when(F.col("capped"), most)
                       .otherwise(F.col("weight") * F.col("level.l") / F.col("level.w")).alias("target"))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``(no_source, src, source_size, target, whole, below)``: every document of
    the source is taken ``whole`` times, and those with a hash point below
    ``below`` once more.

    ``sized`` has rows ``(no_source, src, point, size)``. Each level sums sizes
    by bucket (partial sums before the shuffle, so a hot source costs 4,096 rows
    a task) and keeps the documents of the boundary bucket only."""
    key = ["no_source", "src"]
    goal = targets.withColumn("whole", F.when(F.col("source_size") > 0,
                                              F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    goal = goal.withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    rows, want, found = sized.select(*key, "point", "size"), goal.select(*key, "need"), None
    running = Window.partitionBy(*key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    for level in range(LEVELS + 1):
        last = level == LEVELS
        bucket = F.col("point") if last else F.substring("point", 1, DIGITS * (level + 1))
        sums = (rows.withColumn("bucket", bucket).groupBy(*key, "bucket").agg(F.sum("size").alias("size"))
                .withColumn("before", F.coalesce(F.sum("size").over(running), F.lit(0)))
                .join(want, key).where((F.col("before") <= F.col("need")) & (F.col("before") + F.col("size") > F.col("need"))))
        edge = written(sums.select(*key, "bucket", (F.col("need") - F.col("before")).alias("need"), "size"), "mix-edge")
        if last:
            # The document at the boundary is taken if that comes nearer to the target.
            over = F.col("size") - F.col("need") < F.col("need")
            found = edge.select(*key, F.when(over, F.concat("bucket", F.lit("~"))).otherwise(F.col("bucket")).alias("below"))
        else:
            rows = (rows.withColumn("bucket", bucket).join(edge.select(*key, "bucket"), [*key, "bucket"], "left_semi")
                    .drop("bucket"))
            want = edge.select(*key, "need")
    return goal.join(found, key, "left").select(*key, "source_size", "target", "whole",
                                                F.when(F.col("need") > 0, F.coalesce("below", F.lit("")))
                                                 .otherwise("").alias("below"))


def _plan(sized: DataFrame, weights, share: float, cap: float) -> DataFrame:
    targets = written(source_targets(sized, weights, share, cap), "mix-targets")
    plan = written(thresholds(sized, targets), "mix-plan")
    return F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan


def _copies() -> Column:
    return F.col("whole") + (F.col("point") < F.col("below")).cast("long")


def mix_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per document: ``(doc_id, source, size, source_size, target,
    copies, taken)``. The texts are read once, to count their words."""
    sized = written(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                *_source_key(F.col(source_col)), hash_point(F.col(id_col)).alias("point"),
                                n_words(F.col(text_col)).alias("size")), "mix-sized")
    out = sized.join(_plan(sized, weights, share, cap), ["no_source", "src"])
    return out.select("doc_id", "source", "size", "source_size", "target", _copies().alias("copies"),
                      (_copies() * F.col("size")).alias("taken"))


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as the mix takes it
    (0 to ``cap`` times), with the same columns."""
    sized = written(docs.select(*_source_key(F.col(source_col)), hash_point(F.col(id_col)).alias("point"),
                                n_words(F.col(text_col)).alias("size")), "mix-sized")
    rows = docs.select(whole_row(docs), *_source_key(F.col(source_col)), hash_point(F.col(id_col)).alias("point"))
    out = rows.join(_plan(sized, weights, share, cap), ["no_source", "src"]).where(_copies() > 0)
    return out.select("row", F.explode(F.sequence(F.lit(1).cast("long"), _copies())).alias("copy")).select("row.*")


ORACLE = """
WITH sized AS (SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS point,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM {documents}),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM per),
filled AS (SELECT *, 1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
      - coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0::DOUBLE) AS lft,
    sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_weight FROM ranked),
capped AS (SELECT *, 2.0::DOUBLE * source_size * rest_weight <= weight * lft AS capped FROM filled),
level AS (SELECT max(struct_pack(w := rest_weight, l := lft)) AS v FROM capped WHERE NOT capped),
targets AS (SELECT source, source_size,
    CASE WHEN capped THEN 2.0::DOUBLE * source_size ELSE weight * v.l / v.w END AS target FROM capped, level),
goal AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets),
line AS (SELECT s.*, g.source_size, g.target, g.whole, g.target - g.whole * g.source_size AS need,
    sum(size) OVER (PARTITION BY s.source ORDER BY point RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
    sum(size) OVER (PARTITION BY s.source, point) AS here
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, source, size, source_size, target, copies, copies * size AS taken FROM (
  SELECT *, whole + CASE WHEN need > 0 AND (upto <= need OR (upto - here <= need AND upto - need < need - (upto - here))) THEN 1 ELSE 0 END AS copies
  FROM line)
"""
