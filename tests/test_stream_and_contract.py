"""Stream = batch for the line filter; driver contract sanity."""

from pyspark.sql import functions as F

from verdant.streaming.error_filter import error_lines, run_error_filter_once


def test_stream_equals_batch(spark, tmp_path):
    d = tmp_path / "lines"
    rows = [("an error here",), ("fine",), ("error",), ("ERROR upper",), ("",)]
    spark.createDataFrame(rows, "value string").coalesce(1).write.parquet(str(d / "part1"))
    spark.createDataFrame([("second error",)], "value string").write.parquet(str(d / "part2"))
    batch = spark.read.parquet(str(d / "part1"), str(d / "part2"))
    expect = sorted(r.value for r in error_lines(batch).collect())
    src = str(d)
    got = run_error_filter_once(spark, src + "/*", "value STRING", col="value")
    assert sorted(r.value for r in got.collect()) == expect == ["an error here", "error", "second error"]


def test_contract_keys():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50
    assert E.FLAGSHIP in q


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["url", "score", "prediction", "description"]
    rows = df.collect()
    assert len(rows) == 50
    assert {r.description for r in rows} <= {"ephemeral", "evergreen"}
    assert df.where(F.col("prediction").isNull()).count() == 0


def test_timed_trigger_picks_up_new_files(spark, tmp_path):
    from verdant.streaming.error_filter import file_stream, start_filter
    src = tmp_path / "in"
    src.mkdir()
    spark.createDataFrame([("error one",), ("ok",)], "value string").write.parquet(str(src / "a"))
    sdf = file_stream(spark, str(src) + "/*", "value STRING")
    q = start_filter(sdf, str(tmp_path / "out"), str(tmp_path / "ck"), interval="1 second")
    try:
        q.processAllAvailable()
        spark.createDataFrame([("late error",), ("fine",)], "value string").write.parquet(str(src / "b"))
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted(r.value for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == ["error one", "late error"]
