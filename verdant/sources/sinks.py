"""Writers (K1, K2, K5, K7) and the ordered preview helper."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def save_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """K1: write a result set; by default fail if ``path`` exists."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def save_ordered_text(df: DataFrame, path: str, col: str = "word", mode: str = "errorifexists") -> None:
    """K2: one text file with ``col`` in the DataFrame's order. Meant for a
    bounded, ordered result (a top-k), which ``coalesce(1)`` keeps in order."""
    df.select(F.col(col).cast("string").alias("value")).coalesce(1).write.mode(mode).text(path)


def save_model(model, path: str, overwrite: bool = False) -> None:
    """K3/K5: save any Spark ML model or pipeline model."""
    w = model.write()
    if overwrite:
        w = w.overwrite()
    w.save(path)


def load_model(cls, path: str):
    """K4/K5: ``cls.load(path)`` (e.g. ``LogisticRegressionModel``)."""
    return cls.load(path)


def first_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """A repeatable preview: the first ``n`` rows by ``order``
    (distributed top-k, not an arbitrary ``take``)."""
    return df.orderBy(*order).limit(n)
