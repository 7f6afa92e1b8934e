"""Word statistics: tokenise, drop stop words, count, rank (J6), plus the
session-count ranking of tab-separated logs (commented job in J6)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.functions.text import java_split, jvm_trim, normalize_words
from verdant.operators.broadcast import broadcast_if_small

# Default stop list (a user normally passes their own file).
DEFAULT_STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is",
    "it", "of", "on", "or", "that", "the", "this", "to", "was", "with",
    "le", "la", "les", "de", "des", "et", "un", "une",
    "der", "die", "das", "und", "ein", "el", "los", "las", "y",
)


def stop_words_frame(spark: SparkSession, words: Iterable[str] | DataFrame | str | None = None) -> DataFrame:
    """Stop list as a one-column DataFrame ``word``; each entry is trimmed.

    ``words`` may be a Python iterable, a DataFrame with a ``value``/``word``
    column, or a path to a text file with one word per line.
    """
    if words is None:
        words = DEFAULT_STOP_WORDS
    if isinstance(words, str):
        words = spark.read.text(words)
    if isinstance(words, DataFrame):
        col = "word" if "word" in words.columns else words.columns[0]
        return words.select(jvm_trim(F.col(col)).alias("word")).distinct()
    uniq = sorted({w.strip("".join(chr(c) for c in range(33))) for w in words})
    return spark.createDataFrame([(w,) for w in uniq], "word string")


def explode_words(lines: DataFrame, text_col: str = "value", mode: str = "words") -> DataFrame:
    """One row per token (``word``). ``mode='words'`` is T1, ``'spaces'`` T2."""
    # Normalise once in a projection; the generator then reads the column
    # (an expensive expression is not inlined twice into the generator).
    s = normalize_words(F.col(text_col)) if mode == "words" else F.col(text_col)
    pattern = r"\s+" if mode == "words" else " "
    tail = r"\s+$" if mode == "words" else " +$"
    staged = lines.select(s.alias("_s")).select("_s", F.regexp_replace("_s", tail, "").alias("_t"))
    toks = F.when((F.col("_t") == "") & (F.col("_s") != ""), F.array().cast("array<string>")) \
        .otherwise(F.split(F.col("_t"), pattern))
    return staged.select(F.explode(toks).alias("word"))


def remove_stop_words(words: DataFrame, stop: DataFrame, known_rows: int | None = None) -> DataFrame:
    """Left-anti join against the stop list, broadcast when it is small
    (map-side, no shuffle of the token stream)."""
    return words.join(broadcast_if_small(stop, known_rows=known_rows), "word", "left_anti")


def word_count(lines: DataFrame, stop: DataFrame | None = None, text_col: str = "value",
               stop_rows: int | None = None) -> DataFrame:
    """A2: ``(word, count)``; partial aggregation before the shuffle, so a hot
    word costs one row per task, not one row per occurrence."""
    words = explode_words(lines, text_col)
    if stop is not None:
        words = remove_stop_words(words, stop, stop_rows)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def top_words(counts: DataFrame, k: int = 100) -> DataFrame:
    """O1/O2: top-k by count, ties broken by the word (TakeOrderedAndProject:
    per-task top-k, then a k-row merge; no full sort)."""
    return counts.orderBy(F.desc("count"), F.asc("word")).limit(k)


def session_rank(log_lines: DataFrame, text_col: str = "value", n_fields: int = 6,
                 key_field: int = 1) -> DataFrame:
    """A3 + P4: keep lines with exactly ``n_fields`` tab-separated fields,
    count by field ``key_field``, rank by count descending (ties by key)."""
    fields = java_split(F.col(text_col), "\t")
    return (log_lines.where(F.size(fields) == n_fields)
            .select(fields.getItem(key_field).alias("session"))
            .groupBy("session").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc("session")))
