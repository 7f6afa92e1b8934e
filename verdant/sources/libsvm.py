"""LibSVM text format (S2): ``label index:value ...`` with 1-based indices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """``(label double, features vector)``; 0-based sparse vectors. Give
    ``num_features`` to skip the extra pass that finds the width."""
    r = spark.read.format("libsvm")
    if num_features:
        r = r.option("numFeatures", num_features)
    return r.load(path)


def write_libsvm(df: DataFrame, path: str, label: str = "label", features: str = "features") -> None:
    """Spark's LibSVM writer: ``label i:v ...`` (1-based), doubles in their
    shortest exact decimal form, so a read-back gives the same values."""
    (df.select(F.col(label).cast("double").alias("label"), F.col(features).alias("features"))
     .write.mode("errorifexists").format("libsvm").save(path))
