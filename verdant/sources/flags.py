"""Flag records: ``barcode,m1,...,m6,label`` CSV lines.

``flag_lines`` derives such lines from the data set (labelled documents);
``synthetic_flags`` is the seeded generator, for tests and demos only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.operators.broadcast import MAX_BROADCAST_BYTES, is_small
from verdant.sources.tables import spread, table

FLAG_DDL = ("barcode STRING, m1 INT, m2 INT, m3 INT, m4 INT, m5 INT, m6 INT, label INT")
FLAG_FEATURES = ("m1", "m2", "m3", "m4", "m5", "m6")


def _doc_facts(d: DataFrame, *keep: str) -> DataFrame:
    """Per-document 0/1 facts (computed from the text, map-side)."""
    return d.select(
        "doc_id", *keep,
        (F.col("lang") == "en").cast("int").alias("f_en"),
        (F.col("n_chars") > 2000).cast("int").alias("f_long"),
        F.col("text").rlike("[0-9]").cast("int").alias("f_digit"),
        F.col("text").contains("@").cast("int").alias("f_at"),
        F.col("text").contains('"').cast("int").alias("f_quote"))


def flag_lines(spark: SparkSession, sf_dir: str,
               max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """One CSV line per labelled document; the six 0/1 flags are simple
    document facts (language, length, toxicity, digits, '@', quotes), the
    label is the quality mark. Labels whose files are under a bound are broadcast;
    beyond it the facts are computed map-side and only they are shuffled."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    if is_small(labels, max_broadcast_bytes):
        j = spread(docs.join(F.broadcast(labels), "doc_id"), "doc_id", like=docs)
        facts = _doc_facts(j, "quality", "toxic")
    else:
        facts = _doc_facts(spread(docs, "doc_id")).join(labels, "doc_id")
    cols = [F.col("doc_id"), F.col("f_en"), F.col("f_long"), (F.col("toxic") == 1).cast("int"),
            F.col("f_digit"), F.col("f_at"), F.col("f_quote"), F.col("quality")]
    return facts.select(F.concat_ws(",", *[c.cast("string") for c in cols]).alias("value"))


def parse_flags(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """CSV line -> ``(barcode, label double, m1..m6 double)``; a field that is no number fails."""
    rec = F.from_csv(F.col(text_col), FLAG_DDL, {"mode": "FAILFAST"})
    return lines.select(rec.alias("r")).select(
        F.col("r.barcode").alias("barcode"),
        F.col("r.label").cast("double").alias("label"),
        *[F.col(f"r.{m}").cast("double").alias(m) for m in FLAG_FEATURES])


def synthetic_flags(spark: SparkSession, n: int = 10, seed: int = 7,
                    prefix: str = "2310000") -> DataFrame:
    """``n`` random flag lines, ids ``prefix + i``; seeded and
    distributed (``spark.range``), any size."""
    r = spark.range(n)
    cols = [(F.rand(seed + k) < 0.5).cast("int").cast("string") for k in range(7)]
    return r.select(F.concat_ws(",", F.concat(F.lit(prefix), F.col("id").cast("string")), *cols)
                    .alias("value"))
