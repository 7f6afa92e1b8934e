"""Registered feature queries (S1 layout, P5, P6, F1-F4, R1, R2, U1, A1, S6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from verdant.operators.features import (category_dictionary, features_array, fit_features, one_hot_array,
                                        page_layout, parse_pages)
from verdant.operators.split import split_counts, split_label, union_labelled
from verdant.functions.text import strip_quotes
from verdant.plans.registry import query
from verdant.session import scratch_path, written
from verdant.sources.flags import flag_lines, parse_flags
from verdant.sources.pages import labelled_page_rows, read_page_tsv, unlabelled_page_rows, write_page_tsv
from verdant.sources.tables import table

NUMERICS = ("x_chars", "x_lines", "x_tokens", "x_punct", "x_distinct")


def r6(c):
    """Round to 6 places; ``+ 0.0`` folds a negative zero into zero."""
    return F.round(c, 6) + F.lit(0.0)


# ---- DuckDB building blocks -------------------------------------------------

def _num(v: str) -> str:
    return f"""'"' || coalesce(({v})::BIGINT::VARCHAR, '?') || '"'"""


def _text_numerics(t: str) -> str:
    words = f"list_filter(string_split_regex({t}, '\\s+'), lambda x: x <> '')"
    lwords = f"list_filter(string_split_regex(lower({t}), '\\s+'), lambda x: x <> '')"
    return ",\n    ".join([
        _num(f"length({t})") + " AS x_chars",
        _num(f"len(string_split_regex({t}, '\\r\\n|\\r|\\n'))") + " AS x_lines",
        _num(f"len({words})") + " AS x_tokens",
        _num(f"CASE WHEN length({t}) > 0 THEN length({t}) - length(translate({t}, '.,;:!?', '')) END")
        + " AS x_punct",
        _num(f"CASE WHEN len({lwords}) > 0 THEN list_unique({lwords}) END") + " AS x_distinct",
    ])


SQL_RAW_TRAIN = f"""
raw AS (
  SELECT '"http://' || d.source || '.example/doc/' || d.doc_id::VARCHAR || '"' AS url,
         '"' || d.doc_id::VARCHAR || '"' AS urlid,
         '"' || d.source || '"' AS boilerplate,
         '"' || coalesce(d.lang, '?') || '"' AS category,
    {_text_numerics('d.text')},
         '"' || l.quality::VARCHAR || '"' AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)"""

SQL_RAW_PAGES = f"""
ptext AS (
  SELECT page_id, url, regexp_extract(html, '<html lang="(\\w+)"', 1) AS lang,
         regexp_replace(regexp_replace(regexp_replace(html,
            '(?s)<script[^>]*>.*?</script>', ' ', 'g'),
            '(?s)<style[^>]*>.*?</style>', ' ', 'g'),
            '<[^>]*>', ' ', 'g') AS text
  FROM pages
),
praw AS (
  SELECT '"' || url || '"' AS url, '"' || page_id::VARCHAR || '"' AS urlid, '"html"' AS boilerplate,
         '"' || CASE WHEN lang = '' THEN '?' ELSE lang END || '"' AS category,
    {_text_numerics('text')}
  FROM ptext
)"""


def _clean_num_sql(c: str) -> str:
    return f"CASE WHEN replace({c}, '\"', '') = '?' THEN 0.0::DOUBLE ELSE replace({c}, '\"', '')::DOUBLE END"


SQL_PARSED = f"""
parsed AS (
  SELECT replace(url, '"', '') AS url, category,
         {', '.join(_clean_num_sql(c) + ' AS ' + c for c in NUMERICS)},
         replace(label, '"', '')::DOUBLE AS label
  FROM raw
),
dict AS (
  SELECT category, (row_number() OVER (ORDER BY category) - 1)::INTEGER AS category_index
  FROM (SELECT DISTINCT category FROM parsed)
),
onehot AS (
  SELECT p.*, d.category_index,
         list_transform(range(0, (SELECT count(*) FROM dict)),
                        lambda i: CASE WHEN i = d.category_index THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS oh
  FROM parsed p JOIN dict d ON p.category = d.category
),
feat AS (
  SELECT url, list_concat(oh, [{', '.join(NUMERICS)}]) AS f FROM onehot
)"""


def _parsed_train(spark, sf_dir):
    return parse_pages(labelled_page_rows(spark, sf_dir), has_label=True)


@query("clean_fields", oracle=f"""
WITH {SQL_RAW_TRAIN}
SELECT {', '.join(f"replace({c}, '\"', '') AS {c}" for c in
                  ('url', 'urlid', 'boilerplate', 'category', *NUMERICS, 'label'))}
FROM raw""")
def q_clean_fields(spark, sf_dir):
    """P5: every field of the page table with double quotes removed."""
    raw = labelled_page_rows(spark, sf_dir)
    return raw.select(*[strip_quotes(c).alias(c) for c in raw.columns])


@query("clean_numeric", oracle=f"WITH {SQL_RAW_TRAIN}, {SQL_PARSED} SELECT * FROM parsed")
def q_clean_numeric(spark, sf_dir):
    """P6 (+P5, T5, §1.3 rules): positional parse to typed columns; ``?`` ->
    0.0, a non-number fails, label checked to be 0/1."""
    return _parsed_train(spark, sf_dir)


@query("category_index", oracle=f"WITH {SQL_RAW_TRAIN}, {SQL_PARSED} SELECT * FROM dict")
def q_category_index(spark, sf_dir):
    """F1 + D1: distinct categories -> alphabetical 0-based index."""
    return category_dictionary(_parsed_train(spark, sf_dir))


@query("category_onehot", oracle=f"""
WITH {SQL_RAW_TRAIN}, {SQL_PARSED}
SELECT url, oh AS category_onehot FROM onehot""")
def q_category_onehot(spark, sf_dir):
    """full one-hot (no level dropped) by a join with the dictionary."""
    parsed = written(_parsed_train(spark, sf_dir), "pages")
    d = category_dictionary(parsed)
    width = d.count()
    j = parsed.join(d, "category")
    return j.select("url", one_hot_array(F.col("category_index"), width).alias("category_onehot"))


@query("page_features", oracle=f"""
WITH {SQL_RAW_TRAIN}, {SQL_PARSED}
SELECT url, f AS features FROM feat""")
def q_page_features(spark, sf_dir):
    """the fitted feature model (dictionary, one-hot, assembler) applied to
    all labelled pages, vector shown as an array."""
    parsed = written(_parsed_train(spark, sf_dir), "pages")
    model = fit_features(parsed, NUMERICS, scale=False)
    return model.transform(parsed).select("url", features_array("features").alias("features"))


@query("standard_scale", oracle=f"""
WITH {SQL_RAW_TRAIN}, {SQL_PARSED},
cells AS (SELECT url, generate_subscripts(f, 1) AS i, unnest(f) AS v FROM feat),
stats AS (SELECT i, avg(v) AS mu, stddev_samp(v) AS sd FROM cells GROUP BY i),
scaled AS (
  SELECT c.url, c.i,
         CASE WHEN s.sd = 0 OR s.sd IS NULL THEN 0.0::DOUBLE ELSE round((c.v - s.mu) / s.sd, 6) + 0.0 END AS v
  FROM cells c JOIN stats s ON c.i = s.i)
SELECT url, list(v ORDER BY i) AS features FROM scaled GROUP BY url""")
def q_standard_scale(spark, sf_dir):
    """StandardScaler(withMean, withStd) on the assembled vectors."""
    parsed = written(_parsed_train(spark, sf_dir), "pages")
    model = fit_features(parsed, NUMERICS, scale=True)
    return model.transform(parsed).select(
        "url", F.transform(features_array("features"), r6).alias("features"))


SQL_SPLIT = """CASE WHEN ((((doc_id % 2147483648) * 2654435761) % 4294967296) * 10000) >> 32 < 8000 THEN 'train'
            WHEN ((((doc_id % 2147483648) * 2654435761) % 4294967296) * 10000) >> 32 < 9000 THEN 'validation'
            ELSE 'test' END"""


def _tagged(spark, sf_dir):
    raw = labelled_page_rows(spark, sf_dir)
    doc_id = strip_quotes("urlid").cast("long")
    return raw.select(doc_id.alias("doc_id"), split_label(doc_id).alias("split"))


@query("hash_split", oracle=f"SELECT doc_id, {SQL_SPLIT} AS split FROM labels")
def q_hash_split(spark, sf_dir):
    """R1 (repeatable): 80/10/10 train/validation/test by a key hash."""
    return _tagged(spark, sf_dir)


@query("split_counts", oracle=f"""
SELECT split, count(*)::BIGINT AS n FROM (SELECT {SQL_SPLIT} AS split FROM labels) GROUP BY split""")
def q_split_counts(spark, sf_dir):
    """A1: size of each part in one aggregation."""
    return split_counts(_tagged(spark, sf_dir))


@query("random_split", oracle="""
SELECT 'http://' || d.source || '.example/doc/' || d.doc_id::VARCHAR AS url,
       CASE WHEN ((((d.doc_id % 2147483648) * 2654435761) % 4294967296) * 10000) >> 32 < 6000 THEN 0 ELSE 1 END AS part
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def q_random_split(spark, sf_dir):
    """R2 as a repeatable split 0.6/0.4 of the labelled pages by a key hash: the
    same on every cluster size."""
    raw = labelled_page_rows(spark, sf_dir)
    part = split_label(strip_quotes("urlid").cast("long"), (0.6, 0.4), ("0", "1"))
    return raw.select(strip_quotes("url").alias("url"), part.cast("int").alias("part"))


@query("page_tsv", oracle=f"WITH {SQL_RAW_TRAIN}, {SQL_PARSED} SELECT * FROM parsed")
def q_page_tsv(spark, sf_dir):
    """The labelled pages written as tab-separated files with a header each,
    read back by the positional reader and parsed."""
    path = scratch_path(spark, "page-tsv")
    write_page_tsv(labelled_page_rows(spark, sf_dir), path)
    return parse_pages(read_page_tsv(spark, path), has_label=True)


@query("label_union", oracle="""
SELECT doc_id, 1.0::DOUBLE AS label FROM labels WHERE toxic = 1
UNION ALL
SELECT doc_id, 0.0::DOUBLE AS label FROM labels WHERE toxic = 0""")
def q_label_union(spark, sf_dir):
    """P10 + U1: spam (toxic) tagged 1.0, ham tagged 0.0, union all."""
    lab = table(spark, sf_dir, "labels")
    return union_labelled(lab.where("toxic = 1").select("doc_id"), lab.where("toxic = 0").select("doc_id"))


SQL_FLAG_LINES = """
flag_lines AS (
  SELECT concat_ws(',', d.doc_id::VARCHAR, (d.lang = 'en')::INT::VARCHAR, (d.n_chars > 2000)::INT::VARCHAR,
                   (l.toxic = 1)::INT::VARCHAR, regexp_matches(d.text, '[0-9]')::INT::VARCHAR,
                   contains(d.text, '@')::INT::VARCHAR, contains(d.text, '"')::INT::VARCHAR,
                   l.quality::VARCHAR) AS value
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
),
flags AS (
  SELECT string_split(value, ',')[1] AS barcode, string_split(value, ',')[8]::DOUBLE AS label,
         string_split(value, ',')[2]::DOUBLE AS m1, string_split(value, ',')[3]::DOUBLE AS m2,
         string_split(value, ',')[4]::DOUBLE AS m3, string_split(value, ',')[5]::DOUBLE AS m4,
         string_split(value, ',')[6]::DOUBLE AS m5, string_split(value, ',')[7]::DOUBLE AS m6
  FROM flag_lines
)"""


@query("parse_flag_csv", oracle=f"WITH {SQL_FLAG_LINES} SELECT * FROM flags")
def q_parse_flag_csv(spark, sf_dir):
    """Flag CSV lines (derived from labelled documents) -> typed records."""
    return parse_flags(flag_lines(spark, sf_dir))


@query("score_rows", oracle=f"""
WITH {SQL_RAW_PAGES}
SELECT replace(url, '"', '') AS url, category,
       {', '.join(_clean_num_sql(c) + ' AS ' + c for c in NUMERICS)}
FROM praw""")
def q_score_rows(spark, sf_dir):
    """S1 scoring layout (no label column) parsed from raw pages."""
    raw = unlabelled_page_rows(spark, sf_dir)
    page_layout(raw, has_label=False)
    return parse_pages(raw, has_label=False)
