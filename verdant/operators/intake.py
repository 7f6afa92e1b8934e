"""Reading page tables with an account of what was wrong in them.

``split_rejects`` parses once and gives typed rows and a table of rejected
fields, instead of dropping rows without a trace. ``observed`` counts along with
a job, without a scan of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from verdant.functions.text import strip_quotes
from verdant.operators.features import _numeric_names, _ref, clean_numeric, page_layout
from verdant.session import written


def bad_fields(raw: DataFrame, has_label: bool) -> Column:
    """Array of ``(field, raw, reason)`` of a row's fields that can't be read: ``not a number`` (``?`` is one, 0.0),
    ``missing``, or ``not 0 or 1`` for the label."""
    lay = page_layout(raw, has_label)
    entry = lambda name, c, reason: F.struct(F.lit(name).alias("field"), _ref(c).alias("raw"), reason.alias("reason"))
    missing = lambda c, reason: F.when(_ref(c).isNull(), F.lit("missing")).otherwise(F.lit(reason))
    tests = [(clean_numeric(_ref(c), "null").isNull(), entry(n, c, missing(c, "not a number")))
             for c, n in zip(lay.numerics, _numeric_names(lay.numerics), strict=True)]
    if has_label:
        label = strip_quotes(_ref(lay.label)).try_cast("double")
        tests.append((~F.coalesce(label.isin(0.0, 1.0), F.lit(False)), entry("label", lay.label, missing(lay.label, "not 0 or 1"))))
    return F.filter(F.array(*[F.when(bad, e) for bad, e in tests]), lambda x: x.isNotNull())


def split_rejects(raw: DataFrame, has_label: bool) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)`` from one pass over the input, written once: ``good`` has the rows of ``parse_pages`` whose
    fields can all be read, ``rejects`` one row ``(url, field, raw, reason)`` for every field that can't. Every input
    row is in ``good`` or has rows in ``rejects``."""
    lay = page_layout(raw, has_label)
    names = _numeric_names(lay.numerics)
    cols = [strip_quotes(_ref(lay.url)).alias("url"), _ref(lay.category).alias("category"),
            *[clean_numeric(_ref(c), "null").alias(n) for c, n in zip(lay.numerics, names, strict=True)]]
    if has_label:
        cols.append(strip_quotes(_ref(lay.label)).try_cast("double").alias("label"))
    parsed = written(raw.select(*cols, bad_fields(raw, has_label).alias("_bad")), "intake")
    good = parsed.where(F.size("_bad") == 0).drop("_bad")
    return good, parsed.select("url", F.explode("_bad").alias("b")).select("url", "b.field", "b.raw", "b.reason")


def observed(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Observation]:
    """``df`` with aggregates that are known after its next action (``observation.get``).

    A Spark session with observations can no longer ship models that hold a training summary (logistic regressions
    fresh from a fit) to its tasks, so count in a ``spark.newSession()`` where such models are used as well."""
    seen = Observation(name)
    return df.observe(seen, *[c.alias(k) for k, c in counts.items()]), seen


def observed_intake(raw: DataFrame, dictionary: DataFrame, has_label: bool):
    """``(rows, observations)``: parsed rows with their category index (null: unseen); after one action the observations
    tell ``rows``, ``bad_rows`` and ``bad_fields`` of the input and ``unseen_categories`` of the readable rows."""
    bad = F.size(bad_fields(raw, has_label))
    counted, intake = observed(raw.withColumn("_bad", bad), "intake", rows=F.count(F.lit(1)),
                               bad_rows=F.count_if(F.col("_bad") > 0), bad_fields=F.coalesce(F.sum("_bad"), F.lit(0)))
    lay = page_layout(raw, has_label)
    good = counted.where("_bad = 0").select(
        strip_quotes(_ref(lay.url)).alias("url"), _ref(lay.category).alias("category"),
        *[clean_numeric(_ref(c), "null").alias(n) for c, n in zip(lay.numerics, _numeric_names(lay.numerics), strict=True)])
    indexed = good.join(dictionary.select("category", "category_index"), "category", "left")
    out, categories = observed(indexed, "categories", unseen_categories=F.count_if(F.col("category_index").isNull()))
    return out, (intake, categories)
