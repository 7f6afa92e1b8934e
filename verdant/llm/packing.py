"""Packing into optimal length buckets.

Documents longer than ``max_len`` are cut into pieces of at most that length, so
the global histogram of piece lengths has at most ``max_len`` rows. Dynamic
programming over it picks the bucket boundaries that minimise the padding (each
piece is padded to the upper boundary of its bucket). Inside a bucket, pieces
are put in the order of a hash and cut into batches of as many padded pieces as
the token budget holds.

A bucket may hold a third of all rows, so it is never ranked in one task: a
piece's place is the number of pieces in the hash cells before its own (4,096
cells a bucket, counted with partial sums) plus its place in its cell.

Defined results: a text without words (or null) gives one row with length 0 and
no bucket, batch or slot; repeated rows are packed each; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.llm.common import n_words, written

MAX_LEN = 8192          # bounds the histogram collected for the dynamic program
N_BUCKETS = 16
TOKEN_BUDGET = 65_536
CELL_DIGITS = 3


def optimal_boundaries(lengths: list[int], counts: list[int], n_buckets: int) -> list[int]:
    """Upper boundaries of at most ``n_buckets`` buckets with the least padding.

    ``lengths`` ascend and are distinct. With C and S the running counts and
    running token sums, a bucket over lengths i+1..j pads
    ``lengths[j] * (C[j] - C[i]) - (S[j] - S[i])``. Integers throughout; of
    equal splits the one with the smallest i is taken."""
    n = len(lengths)
    if n == 0:
        return []
    b = np.asarray(lengths, dtype=np.int64)
    c = np.concatenate([[0], np.cumsum(np.asarray(counts, dtype=np.int64))])
    s = np.concatenate([[0], np.cumsum(b * np.asarray(counts, dtype=np.int64))])
    k_all = min(n_buckets, n)
    best = b * c[1:] - s[1:]                      # one bucket over 1..j
    came = [np.zeros(n + 1, dtype=np.int64)]
    for k in range(2, k_all + 1):
        now, arg = np.full(n, np.iinfo(np.int64).max), np.zeros(n + 1, dtype=np.int64)
        for j in range(k, n + 1):                 # the last bucket covers i+1..j
            cost = best[k - 2:j - 1] - b[j - 1] * c[k - 1:j] + s[k - 1:j]
            at = int(np.argmin(cost))
            now[j - 1], arg[j] = cost[at] + b[j - 1] * c[j] - s[j], at + k - 1
        best = now
        came.append(arg)
    out, j = [], n
    for k in range(k_all, 0, -1):
        out.append(int(b[j - 1]))
        j = int(came[k - 1][j])
    return out[::-1]


def pieces(docs: DataFrame, length: Column, id_col: str, max_len: int) -> DataFrame:
    """``(doc_id, piece, start, length)``; a document without words has one piece of length 0."""
    sized = docs.select(F.col(id_col).alias("doc_id"), length.cast("long").alias("total"))
    last = F.greatest(F.lit(0).cast("long"), F.floor((F.col("total") - 1) / max_len).cast("long"))
    return (sized.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
            .select("doc_id", "piece", (F.col("piece") * max_len).alias("start"),
                    F.least(F.col("total") - F.col("piece") * max_len, F.lit(max_len).cast("long")).alias("length")))


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: Column | None = None,
         max_len: int = MAX_LEN, n_buckets: int = N_BUCKETS, token_budget: int = TOKEN_BUDGET) -> DataFrame:
    """``(doc_id, piece, start, length, bucket, padded, batch, slot)``, one row
    per piece: tokens ``start .. start + length`` of the document are sequence
    ``slot`` of batch ``batch`` of its bucket, padded to ``padded`` tokens.

    ``length`` is the token count of a row (default: its number of words)."""
    if token_budget < max_len:
        raise ValueError("token_budget must hold one piece of max_len tokens")
    cut = written(pieces(docs, n_words(F.col(text_col)) if length is None else length, id_col, max_len)
                  .withColumn("point", F.md5(F.concat_ws("-", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "piece"))),
                  "pack-pieces")
    # At most max_len rows reach the driver.
    histogram = sorted((r["length"], r["n"]) for r in
                       cut.where("length > 0").groupBy("length").agg(F.count("*").alias("n")).collect())
    bounds = optimal_boundaries([x for x, _ in histogram], [n for _, n in histogram], n_buckets)
    if not bounds:
        bounds = [max_len]
    edges = F.array(*[F.lit(x).cast("long") for x in bounds])
    inside = cut.where("length > 0").withColumn(
        "bucket", F.size(F.filter(edges, lambda x: x < F.col("length"))).cast("long"))
    inside = inside.withColumn("padded", F.element_at(edges, (F.col("bucket") + 1).cast("int")))
    inside = inside.withColumn("cell", F.substring("point", 1, CELL_DIGITS))
    cells = inside.groupBy("bucket", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("bucket", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    in_cell = Window.partitionBy("bucket", "cell").orderBy("point", "doc_id", "piece", "length")
    per_batch = F.floor(F.lit(token_budget) / F.col("padded")).cast("long")
    placed = (inside.withColumn("place", F.row_number().over(in_cell) - 1).join(offsets, ["bucket", "cell"])
              .withColumn("place", F.col("place") + F.col("offset")))
    none = F.lit(None).cast("long")
    names = ["doc_id", "piece", "start", "length", "bucket", "padded", "batch", "slot"]
    return placed.select(*names[:6], F.floor(F.col("place") / per_batch).cast("long").alias("batch"),
                         (F.col("place") % per_batch).alias("slot")).unionByName(
        cut.where("length = 0").select(*names[:4], *[none.alias(x) for x in names[4:]]))


def oracle(documents: str = "documents", max_len: int = MAX_LEN, n_buckets: int = N_BUCKETS,
           token_budget: int = TOKEN_BUDGET) -> str:
    """The same rows in DuckDB SQL, the dynamic program unrolled."""
    steps, back = [], []
    for k in range(2, n_buckets + 1):
        steps.append(f"""d{k} AS MATERIALIZED (SELECT h.j, min(p.v + h.len * (h.c - q.c) - (h.s - q.s)) AS v,
    arg_min(p.j, (p.v + h.len * (h.c - q.c) - (h.s - q.s), p.j)) AS i
  FROM h JOIN d{k - 1} p ON p.j < h.j JOIN h q ON q.j = p.j GROUP BY h.j)""")
    ks = "least({}, (SELECT max(j) FROM h))".format(n_buckets)
    for k in range(n_buckets, 0, -1):
        prev = f"SELECT i AS j FROM b{k + 1} WHERE i > 0 UNION ALL " if k < n_buckets else ""
        back.append(f"""b{k} AS MATERIALIZED (SELECT d.j, d.i FROM d{k} d JOIN (
    {prev}SELECT max(j) AS j FROM h HAVING {ks} = {k}) t ON d.j = t.j)""")
    bounds = " UNION ALL ".join(f"SELECT j FROM b{k}" for k in range(1, n_buckets + 1))
    nl = ",\n"
    return f"""
WITH sized AS (SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS total
  FROM {documents}),
cut AS MATERIALIZED (SELECT doc_id, piece, piece * {max_len} AS start, least(total - piece * {max_len}, {max_len}) AS length,
    md5(coalesce(doc_id::VARCHAR, '') || '-' || piece::VARCHAR) AS point
  FROM (SELECT doc_id, total, unnest(range(0, greatest(0, (total - 1) // {max_len}) + 1)) AS piece FROM sized)),
g AS (SELECT length AS len, count(*)::BIGINT AS n FROM cut WHERE length > 0 GROUP BY length),
h AS MATERIALIZED (SELECT len, row_number() OVER (ORDER BY len) AS j, (sum(n) OVER (ORDER BY len))::BIGINT AS c,
    (sum(n * len) OVER (ORDER BY len))::BIGINT AS s FROM g),
d1 AS MATERIALIZED (SELECT j, len * c - s AS v, 0::BIGINT AS i FROM h),
{nl.join(steps)},
{nl.join(back)},
bounds AS (SELECT h.len AS padded, row_number() OVER (ORDER BY h.len) - 1 AS bucket FROM ({bounds}) b JOIN h ON h.j = b.j),
inside AS (SELECT cut.*, bucket, padded, row_number() OVER (PARTITION BY bucket ORDER BY point, doc_id, piece, length) - 1 AS place
  FROM cut ASOF JOIN bounds ON cut.length <= bounds.padded WHERE length > 0)
SELECT doc_id, piece, start, length, bucket, padded, place // ({token_budget} // padded) AS batch, place % ({token_budget} // padded) AS slot FROM inside
UNION ALL SELECT doc_id, piece, start, length, NULL, NULL, NULL, NULL FROM cut WHERE length = 0
"""
