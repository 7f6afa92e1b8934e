"""Registered text queries (J6 word count, J7 filter, T1-T4, A3, P4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from verdant.functions.text import (contains, text_checksum, tokenize_spaces, tokenize_words,
                                    utf16_low_byte_sum, checksum_from_byte_sum)
from verdant.operators.wordcount import (DEFAULT_STOP_WORDS, explode_words, remove_stop_words,
                                         session_rank, stop_words_frame, top_words, word_count)
from verdant.plans.registry import query
from verdant.session import scratch_path
from verdant.sources.sinks import save_ordered_text, save_table
from verdant.sources.tables import document_lines, spread, table

# ---- DuckDB building blocks (same semantics as the Spark expressions) ------

SQL_LINES = r"""
lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) - 1 AS line_no, unnest(parts) AS value
  FROM (SELECT doc_id,
               string_split_regex(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n') AS parts
        FROM documents)
)"""

SQL_NORM = "lower(translate(value, chr(9) || '().,!?|[]-;:''', '              '))"

SQL_WORD_TOKENS = rf"""
norm AS (SELECT doc_id, line_no, {SQL_NORM} AS s FROM lines),
tokens AS (
  SELECT unnest(CASE WHEN regexp_replace(s, '\s+$', '') = '' AND s <> '' THEN []::VARCHAR[]
                     ELSE string_split_regex(regexp_replace(s, '\s+$', ''), '\s+') END) AS word
  FROM norm
)"""

SQL_STOP_LIST = ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(set(DEFAULT_STOP_WORDS)))

SQL_WORDCOUNT = rf"""
WITH {SQL_LINES}, {SQL_WORD_TOKENS}
SELECT word, count(*)::BIGINT AS count FROM tokens
WHERE word NOT IN ({SQL_STOP_LIST})
GROUP BY word"""


def _stop(spark):
    return stop_words_frame(spark), len(set(DEFAULT_STOP_WORDS))


@query("src_text_lines", oracle=f"WITH {SQL_LINES} SELECT doc_id, line_no::BIGINT AS line_no, value FROM lines")
def q_src_text_lines(spark, sf_dir):
    """S3: text lines of every document (what ``spark.read.text`` yields)."""
    return document_lines(spark, sf_dir).select("doc_id", F.col("line_no").cast("long").alias("line_no"), "value")


@query("tokenize_words", oracle=rf"""
WITH {SQL_LINES},
norm AS (SELECT doc_id, line_no, {SQL_NORM} AS s FROM lines)
SELECT doc_id, line_no::BIGINT AS line_no,
       CASE WHEN regexp_replace(s, '\s+$', '') = '' AND s <> '' THEN []::VARCHAR[]
            ELSE string_split_regex(regexp_replace(s, '\s+$', ''), '\s+') END AS tokens
FROM norm""")
def q_tokenize_words(spark, sf_dir):
    """Per line, the token array with JVM ``split`` edge semantics."""
    lines = document_lines(spark, sf_dir)
    return lines.select("doc_id", F.col("line_no").cast("long").alias("line_no"),
                        tokenize_words("value").alias("tokens"))


@query("tokenize_spaces", oracle=r"""
SELECT doc_id,
       CASE WHEN regexp_replace(text, ' +$', '') = '' AND text <> '' THEN []::VARCHAR[]
            ELSE string_split(regexp_replace(text, ' +$', ''), ' ') END AS tokens
FROM documents""")
def q_tokenize_spaces(spark, sf_dir):
    """Split whole texts on single blanks, case kept (spam/ham input)."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return docs.select("doc_id", tokenize_spaces("text").alias("tokens"))


@query("stopword_filter", oracle=rf"""
WITH {SQL_LINES}, {SQL_WORD_TOKENS}
SELECT word FROM tokens WHERE word NOT IN ({SQL_STOP_LIST})""")
def q_stopword_filter(spark, sf_dir):
    """Token stream minus the stop list (broadcast left-anti join)."""
    stop, n = _stop(spark)
    return remove_stop_words(explode_words(document_lines(spark, sf_dir)), stop, n)


@query("wordcount", oracle=SQL_WORDCOUNT)
def q_wordcount(spark, sf_dir):
    """A2: counts of all words minus stop words."""
    stop, n = _stop(spark)
    return word_count(document_lines(spark, sf_dir), stop, stop_rows=n)


@query("wordcount_top100", oracle=SQL_WORDCOUNT + "\nORDER BY count DESC, word LIMIT 100")
def q_wordcount_top100(spark, sf_dir):
    """J6 end to end: lines -> tokens -> stop filter -> count -> top 100."""
    stop, n = _stop(spark)
    return top_words(word_count(document_lines(spark, sf_dir), stop, stop_rows=n), 100)


@query("sink_wordcount", oracle=SQL_WORDCOUNT)
def q_sink_wordcount(spark, sf_dir):
    """K1: the counts saved as a table and read back."""
    stop, n = _stop(spark)
    path = scratch_path(spark, "word-counts")
    save_table(word_count(document_lines(spark, sf_dir), stop, stop_rows=n), path)
    return spark.read.schema("word string, count long").parquet(path)


@query("sink_top100", oracle=SQL_WORDCOUNT.replace("SELECT word, count(*)::BIGINT AS count", "SELECT word AS value")
       + "\nORDER BY count(*) DESC, word LIMIT 100")
def q_sink_top100(spark, sf_dir):
    """K2: the top 100 words saved as one ordered text file and read back."""
    stop, n = _stop(spark)
    path = scratch_path(spark, "top-words")
    save_ordered_text(top_words(word_count(document_lines(spark, sf_dir), stop, stop_rows=n), 100), path)
    return spark.read.text(path)


@query("term_frequency", oracle=r"""
WITH toks AS (
  SELECT doc_id,
         unnest(CASE WHEN regexp_replace(text, ' +$', '') = '' AND text <> '' THEN []::VARCHAR[]
                     ELSE string_split(regexp_replace(text, ' +$', ''), ' ') END) AS term
  FROM documents)
SELECT doc_id, term, count(*)::BIGINT AS tf FROM toks GROUP BY doc_id, term""")
def q_term_frequency(spark, sf_dir):
    """F5 without hashing: raw term counts per document (space tokens)."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return (docs.select("doc_id", F.explode(tokenize_spaces("text")).alias("term"))
            .groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf")))


SQL_BYTE_SUM = """list_sum(list_transform(string_split(text, ''), lambda c:
    CASE WHEN unicode(c) < 65536 THEN unicode(c) & 255
         ELSE ((55296 + ((unicode(c) - 65536) >> 10)) & 255) + ((56320 + ((unicode(c) - 65536) & 1023)) & 255)
    END))"""


@query("text_checksum", oracle=f"""
SELECT doc_id, (-(coalesce({SQL_BYTE_SUM}, 0)::BIGINT & 255))::INTEGER AS checksum FROM documents""")
def q_text_checksum(spark, sf_dir):
    """T4: byte checksum of every document text."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return docs.select("doc_id", text_checksum("text").alias("checksum"))


@query("group_checksum", oracle=f"""
SELECT source, count(*)::BIGINT AS n_docs,
       (-(sum(coalesce({SQL_BYTE_SUM}, 0))::BIGINT & 255))::INTEGER AS checksum
FROM documents GROUP BY source""")
def q_group_checksum(spark, sf_dir):
    """Checksum of all texts of a source (order-free: sums commute), as
    a partial/final aggregate, so a huge source is split across tasks."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "doc_id")
    return (docs.select("source", utf16_low_byte_sum("text").alias("b"))
            .groupBy("source")
            .agg(F.count(F.lit(1)).alias("n_docs"), checksum_from_byte_sum(F.sum("b")).alias("checksum")))


@query("filter_contains", oracle="SELECT event_id, user_id, event_type FROM events WHERE contains(event_type, 'error')")
def q_filter_contains(spark, sf_dir):
    """Case-sensitive substring filter (pushed to the parquet scan as a
    StringContains predicate)."""
    ev = table(spark, sf_dir, "events")
    return ev.where(contains("event_type", "error")).select("event_id", "user_id", "event_type")


SQL_EVENT_LINES = """concat_ws(chr(9), strftime(ts, '%Y-%m-%d %H:%M:%S'), user_id::VARCHAR, event_type,
                    value::VARCHAR, props, event_id::VARCHAR)"""


@query("session_query_rank", oracle=f"""
SELECT string_split({SQL_EVENT_LINES}, chr(9))[2] AS session, count(*)::BIGINT AS count
FROM events
WHERE len(string_split({SQL_EVENT_LINES}, chr(9))) = 6
GROUP BY 1""")
def q_session_query_rank(spark, sf_dir):
    """Session log lines (events rendered as 6 tab-separated fields),
    width filter, count per session (field 1), ranked descending."""
    ev = table(spark, sf_dir, "events")
    lines = ev.select(F.concat_ws("\t", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
                                  F.col("user_id").cast("string"), "event_type",
                                  F.col("value").cast("string"), "props",
                                  F.col("event_id").cast("string")).alias("value"))
    return session_rank(lines)
