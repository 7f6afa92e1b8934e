"""Feature engineering on page rows (F1-F4, P5-P6): positional parsing,
category dictionary, full one-hot, assembly and standard scaling.

The category dictionary is a table: it is ranked without a single-task window,
joined on, and never collected, so the number of categories has no bound. The
one-hot block is sparse. Encoding, assembly and scaling are Spark ML
transformers (JVM, distributed).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.functions.text import question_to_zero, strip_quotes
from verdant.session import written

UNSEEN = ("error", "keep", "drop")


@dataclass(frozen=True)
class PageLayout:
    url: str
    category: str
    numerics: tuple[str, ...]
    label: str | None


def page_layout(df: DataFrame, has_label: bool) -> PageLayout:
    """Column roles by position: 0 url, 3 category, 4.. numerics, last label."""
    cols = df.columns
    if len(cols) < (6 if has_label else 5):
        raise ValueError(f"page table too narrow: {cols}")
    nums = cols[4:-1] if has_label else cols[4:]
    return PageLayout(cols[0], cols[3], tuple(nums), cols[-1] if has_label else None)


def clean_numeric(c, on_bad: str = "fail") -> Column:
    """P6 after P5: strip quotes, ``?`` -> 0.0, else a double.

    ``on_bad``: ``fail`` (ANSI cast error), ``zero`` (non-numbers -> 0.0) or
    ``null`` (non-numbers -> NULL, for a later drop)."""
    s = strip_quotes(c)
    if on_bad == "fail":
        return question_to_zero(s)
    tried = F.when(s == "?", F.lit(0.0)).otherwise(s.try_cast("double"))
    return F.coalesce(tried, F.lit(0.0)) if on_bad == "zero" else tried


def checked_label(c) -> Column:
    """Label: ``1``/``0``/``1.0``/``0.0`` accepted; anything else fails."""
    v = strip_quotes(c).cast("double")
    raw = F.col(c) if isinstance(c, str) else c
    return F.when(v.isin(0.0, 1.0), v).otherwise(
        F.raise_error(F.concat(F.lit("label must be 0 or 1, got "), F.coalesce(raw, F.lit("NULL")))))


def parse_pages(raw: DataFrame, has_label: bool, on_bad: str = "fail") -> DataFrame:
    """Typed page rows ``(url, category, x..., [label])``.

    The category keeps its raw text (quotes included), since the dictionary
    is keyed by the unstripped field; all other fields are quote-stripped."""
    lay = page_layout(raw, has_label)
    names = _numeric_names(lay.numerics)
    cols = [strip_quotes(_ref(lay.url)).alias("url"), _ref(lay.category).alias("category")]
    cols += [clean_numeric(_ref(c), on_bad).alias(n) for c, n in zip(lay.numerics, names)]
    if has_label:
        cols.append(checked_label(_ref(lay.label)).alias("label"))
    out = raw.select(*cols)
    if on_bad == "null":
        out = out.dropna(subset=names)
    return out


def _ref(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _numeric_names(raw_names) -> list[str]:
    """Header names without quotes; positional names when they clash."""
    names = [n.replace('"', "").strip() for n in raw_names]
    reserved = {"url", "category", "label"}
    if len(set(names)) != len(names) or reserved & set(names) or any(not n for n in names):
        names = [f"x{i + 1}" for i in range(len(names))]
    return names


def category_dictionary(df: DataFrame, col: str = "category") -> DataFrame:
    """``(category, category_index)``, 0-based, alphabetical.

    The distinct categories are range-partitioned and sorted; an index is the
    number of rows in the partitions before (one row per partition is summed)
    plus the place in the partition."""
    ordered = written(df.select(F.col(col).alias("category")).where(F.col("category").isNotNull()).distinct()
                      .orderBy("category").select("category", F.monotonically_increasing_id().alias("id"))
                      .withColumn("part", F.shiftright("id", 33)), "categories")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return ordered.join(offsets, "part").select(
        "category", (F.col("offset") + F.col("id").bitwiseAND((1 << 33) - 1)).cast("int").alias("category_index"))


def one_hot_array(index: Column, width: int) -> Column:
    """F2 in SQL form: array of ``width`` doubles, 1.0 at ``index``."""
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)),
                       lambda i: F.when(i == index, F.lit(1.0)).otherwise(F.lit(0.0)))


def with_category_index(df: DataFrame, dictionary: DataFrame, unseen: str = "error") -> DataFrame:
    """``category_index`` (double) by a join with the dictionary. A category that
    it does not hold fails (``error``), gets the index after the last
    (``keep``), or its row goes (``drop``)."""
    if unseen not in UNSEEN:
        raise ValueError(f"unseen must be one of {UNSEEN}")
    found = dictionary.select(F.col("category"), F.col("category_index").cast("double").alias("category_index"))
    if unseen == "drop":
        return df.join(found, "category")
    out = df.join(found, "category", "left")
    if unseen == "error":
        missing = F.raise_error(F.concat(F.lit("unseen category "), F.coalesce("category", F.lit("NULL")))).cast("double")
        return out.withColumn("category_index", F.coalesce("category_index", missing))
    return out.withColumn("category_index", F.coalesce("category_index", F.lit(float(dictionary.count()))))


@dataclass
class FeatureModel:
    """Fitted F1-F4: dictionary, one-hot (one slot per category, none dropped),
    assembly of ``[one-hot, numerics...]`` and, if fitted, standard scaling."""
    dictionary: DataFrame
    encoder: OneHotEncoderModel
    numerics: tuple[str, ...]
    unseen: str = "error"
    scaler: StandardScalerModel | None = None

    def assembled(self, df: DataFrame, output: str = "raw_features") -> DataFrame:
        hot = self.encoder.transform(with_category_index(df, self.dictionary, self.unseen))
        return VectorAssembler(inputCols=["category_vec", *self.numerics], outputCol=output).transform(hot)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.scaler.transform(self.assembled(df)) if self.scaler else self.assembled(df, "features")


def fit_scaler(assembled: DataFrame) -> StandardScalerModel:
    """mean and sample standard deviation; a constant column scales to 0.0."""
    return StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True).fit(assembled)


def fit_features(df: DataFrame, numerics, scale: bool, unseen: str = "error",
                 scale_rows: DataFrame | None = None) -> FeatureModel:
    """Fit the feature steps. The category dictionary comes from all of ``df``
    (it uses no labels); the scaler, when asked, is fitted on ``scale_rows``
    (e.g. the training part only) or on ``df``."""
    dictionary = written(category_dictionary(df), "category-index")
    encoder = OneHotEncoder(inputCols=["category_index"], outputCols=["category_vec"], dropLast=False,
                            handleInvalid="keep" if unseen == "keep" else "error")
    model = FeatureModel(dictionary, encoder.fit(dictionary.withColumn("category_index", F.col("category_index").cast("double"))),
                         tuple(numerics), unseen)
    if scale:
        model.scaler = fit_scaler(model.assembled(df if scale_rows is None else scale_rows))
    return model


def continuous(features: str = "features") -> Column:
    """Drop ML attribute metadata so a tree treats one-hot slots as plain
    continuous features (no categorical-feature map)."""
    return F.col(features).alias(features, metadata={})


def features_array(col: str = "features") -> Column:
    return vector_to_array(F.col(col), "float64")
