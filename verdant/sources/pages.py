"""Page tables in the positional tab-separated layout of the classic jobs.

Layout (positions): 0 url, 1-2 ignored, 3 category, 4..n-2 numeric
features, n-1 label; a scoring file has no label column. All fields are
strings, usually double-quoted; a numeric field may be ``?``.

``read_page_tsv`` reads such files. ``labelled_page_rows`` and
``unlabelled_page_rows`` build the same layout from the data set tables:
``labels ⋈ documents`` for training and ``pages`` for scoring.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.functions.features import TEXT_FEATURES
from verdant.operators.broadcast import MAX_BROADCAST_BYTES, is_small
from verdant.sources.tables import spread, table

LANG_PATTERN = r'<html lang="(\w+)"'


def read_page_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated, one header per file, no quote processing (quotes
    stay in the values, as in a plain tab split). All columns are strings."""
    return (spark.read.option("sep", "\t").option("header", True).option("quote", "")
            .option("escape", "").option("inferSchema", False).csv(path))


def write_page_tsv(df: DataFrame, path: str) -> None:
    """The layout that ``read_page_tsv`` reads: one header per file, fields as they are."""
    (df.write.option("sep", "\t").option("header", True).option("quote", "").option("escapeQuotes", False)
     .option("emptyValue", "").csv(path))


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def _num_field(v: Column) -> Column:
    return _quoted(F.coalesce(v.cast("string"), F.lit("?")))


def text_feature_fields(text: Column) -> list[Column]:
    return [_num_field(fn(text)).alias(name) for name, fn in TEXT_FEATURES]


def _doc_fields(d: DataFrame, *extra: Column) -> DataFrame:
    """Page-layout fields of documents (everything but the label)."""
    return d.select(
        "doc_id",
        _quoted(F.concat(F.lit("http://"), F.col("source"), F.lit(".example/doc/"),
                         F.col("doc_id").cast("string"))).alias("url"),
        _quoted(F.col("doc_id").cast("string")).alias("urlid"),
        _quoted(F.col("source")).alias("boilerplate"),
        _quoted(F.coalesce(F.col("lang"), F.lit("?"))).alias("category"),
        *text_feature_fields(F.col("text")),
        *extra,
    )


def labelled_page_rows(spark: SparkSession, sf_dir: str,
                       max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Training stand-in: labelled documents. category = language,
    label = quality.

    Labels whose files are under a bound are broadcast: documents are filtered
    map-side and only labelled texts are processed. Beyond it, the text
    features (a few numbers per document) are computed map-side first and
    only those small rows are shuffled for the join, never the texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    label = _quoted(F.col("quality").cast("string")).alias("label")
    if is_small(labels, max_broadcast_bytes):
        j = spread(docs.join(F.broadcast(labels), "doc_id"), "doc_id", like=docs)
        return _doc_fields(j, label).drop("doc_id")
    fields = _doc_fields(spread(docs, "doc_id"))
    return fields.join(labels, "doc_id").select(*fields.drop("doc_id").columns, label)


def page_text(html: Column) -> Column:
    """Visible text of a page: scripts, styles and tags removed."""
    t = F.regexp_replace(html, r"(?s)<script[^>]*>.*?</script>", " ")
    t = F.regexp_replace(t, r"(?s)<style[^>]*>.*?</style>", " ")
    return F.regexp_replace(t, r"<[^>]*>", " ")


def unlabelled_page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring stand-in: raw web pages, category = ``<html lang>``."""
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "url", "html"), "page_id")
    lang = F.regexp_extract("html", LANG_PATTERN, 1)
    text = page_text(F.col("html"))
    return pages.select(
        _quoted(F.col("url")).alias("url"),
        _quoted(F.col("page_id").cast("string")).alias("urlid"),
        _quoted(F.lit("html")).alias("boilerplate"),
        _quoted(F.when(lang == "", F.lit("?")).otherwise(lang)).alias("category"),
        *text_feature_fields(text),
    )
