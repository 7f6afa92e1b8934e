"""A key holding a third of all rows: results stay exact and whole, and the
plans pre-aggregate before the shuffle."""

import random

from pyspark.sql import functions as F

from verdant.functions.text import checksum_from_byte_sum, utf16_low_byte_sum
from verdant.operators.broadcast import broadcast_if_small
from verdant.operators.metrics import auc, score_curve
from verdant.operators.wordcount import word_count


def _plan(df, capsys):
    df.explain()
    return capsys.readouterr().out


def test_hot_word_counted_exactly_with_partial_aggregation(spark, capsys):
    rnd = random.Random(1)
    lines = []
    for i in range(3000):
        words = ["hot"] + [f"w{rnd.randint(0, 500)}" for _ in range(2)]
        lines.append((" ".join(words),))
    df = spark.createDataFrame(lines, "value string").repartition(6)
    counts = word_count(df)
    got = {r.word: r["count"] for r in counts.collect()}
    assert got["hot"] == 3000 and sum(got.values()) == 9000
    plan = _plan(counts, capsys)
    assert "partial_count" in plan and plan.index("partial_count") > plan.index("Exchange")


def test_hot_score_curve_exact(spark, capsys):
    rnd = random.Random(2)
    rows = [(0.5, float(rnd.randint(0, 1))) for _ in range(1000)]
    rows += [(rnd.random(), float(rnd.randint(0, 1))) for _ in range(2000)]
    df = spark.createDataFrame(rows, "score double, label double").repartition(6)
    curve = score_curve(df, buckets=8)
    res = {r.score: (r.tp, r.fp) for r in curve.collect()}
    for t in (0.5, sorted(res)[0], sorted(res)[-1]):
        tp = sum(1 for s, y in rows if s >= t and y == 1)
        fp = sum(1 for s, y in rows if s >= t and y == 0)
        assert res[t] == (tp, fp)
    P = sum(y for _, y in rows)
    N = len(rows) - P
    mw = 0.0
    pos = sorted(s for s, y in rows if y == 1)
    neg = sorted(s for s, y in rows if y == 0)
    import bisect
    for s in pos:
        mw += bisect.bisect_left(neg, s) + 0.5 * (bisect.bisect_right(neg, s) - bisect.bisect_left(neg, s))
    assert abs(auc(curve).first().auc - mw / (P * N)) < 1e-12
    assert "partial_sum" in _plan(curve, capsys)


def test_hot_source_checksum(spark):
    rows = [("big", f"text {i} é") for i in range(300)] + [(f"s{i % 7}", f"x{i}") for i in range(600)]
    df = spark.createDataFrame(rows, "source string, text string").repartition(5)
    out = {r.source: r.checksum for r in df.groupBy("source").agg(
        checksum_from_byte_sum(F.sum(utf16_low_byte_sum("text"))).alias("checksum")).collect()}
    for src in ("big", "s3"):
        b = sum(sum(t.encode("utf-16-be")[1::2]) for s, t in rows if s == src)
        assert out[src] == -(b & 255)


def test_broadcast_only_under_bound(spark, tmp_path):
    spark.range(5000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    jobs = spark.sparkContext.statusTracker()
    before = set(jobs.getJobIdsForGroup())
    assert broadcast_if_small(df, max_bytes=10) is df
    assert broadcast_if_small(df, max_bytes=1 << 20) is not df
    assert broadcast_if_small(df, max_bytes=10, known_rows=3) is not df
    assert set(jobs.getJobIdsForGroup()) == before          # decided without a job


def test_spread_only_small_inputs(spark, capsys):
    from verdant.sources.tables import SPREAD_LIMIT, spread
    big = spark.range(0, 10000, numPartitions=SPREAD_LIMIT + 4)
    assert spread(big, "id") is big                      # large input: never reshuffled
    small = spark.range(0, 10000, numPartitions=1)
    out = spread(small, "id")
    assert out.rdd.getNumPartitions() == min(spark.sparkContext.defaultParallelism, SPREAD_LIMIT)
    out.explain()
    assert "hashpartitioning(id" in capsys.readouterr().out   # keyed, no round-robin sort
