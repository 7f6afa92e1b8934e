"""File sources and sinks: text lines, stop file, word count outputs,
LibSVM round trip, model save/load."""

import os

import pytest
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.linalg import Vectors

from verdant.operators.learners import fit
from verdant.plans.jobs import run_word_count
from verdant.sources.libsvm import read_libsvm, write_libsvm
from verdant.session import scratch_scope, written
from verdant.sources.sinks import first_rows, load_model, save_model


def test_word_count_files(spark, tmp_path):
    d = tmp_path / "texts"
    d.mkdir()
    (d / "a.txt").write_text("To be, or not to be:\nthat is the question.\n")
    (d / "b.txt").write_text("The rest is silence.\n\n")
    stop = tmp_path / "stop.txt"
    stop.write_text("the\n  is \n")
    counts, top = run_word_count(spark, str(d / "*"), str(stop), str(tmp_path / "counts"),
                                 str(tmp_path / "top"), k=3)
    c = {r.word: r["count"] for r in counts.collect()}
    assert c["to"] == 2 and c["be"] == 2 and "the" not in c and "is" not in c
    assert c[""] == 1   # the empty line yields one empty token, counted
    files = [f for f in os.listdir(tmp_path / "top") if f.startswith("part-")]
    assert len(files) == 1
    lines = (tmp_path / "top" / files[0]).read_text().splitlines()
    assert lines == ["be", "to", ""]   # count 2, 2, then ties at 1 by word
    with pytest.raises(Exception):     # the counts directory already exists
        run_word_count(spark, str(d / "*"), None, str(tmp_path / "counts"))


def test_scratch_scope_deletes_its_own_tables_only(spark, tmp_path):
    folder = lambda df: os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
    outside = written(spark.range(5), "outside")
    with scratch_scope(spark):
        inside = written(spark.range(7), "inside")
        with scratch_scope(spark):
            nested = folder(written(spark.range(3), "nested"))
        assert not os.path.exists(nested) and inside.count() == 7
        inside.write.parquet(str(tmp_path / "kept"))
        gone = folder(inside)
    assert not os.path.exists(gone)
    assert outside.count() == 5 and spark.read.parquet(str(tmp_path / "kept")).count() == 7
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        gone = folder(written(spark.range(7), "inside"))
        raise ZeroDivisionError
    assert not os.path.exists(gone)
    assert os.path.exists(folder(written(spark.range(2), "after")))


def test_libsvm_round_trip(spark, tmp_path):
    p = tmp_path / "s.libsvm"
    p.write_text("1 1:0.5 3:2\n0 2:1\n1\n")
    df = read_libsvm(spark, str(p), num_features=3)
    rows = sorted((r.label, r.features.toArray().tolist()) for r in df.collect())
    assert rows == [(0.0, [0.0, 1.0, 0.0]), (1.0, [0.0, 0.0, 0.0]), (1.0, [0.5, 0.0, 2.0])]
    out = str(tmp_path / "out")
    write_libsvm(df, out)
    back = sorted((r.label, r.features.toArray().tolist()) for r in read_libsvm(spark, out, 3).collect())
    assert back == rows


def test_model_save_load_and_preview(spark, tmp_path):
    df = spark.createDataFrame([(float(i % 2), Vectors.dense([float(i % 2), 1.0])) for i in range(20)],
                               ["label", "features"])
    m = fit("lr_lbfgs", df).model
    save_model(m, str(tmp_path / "lr"))
    m2 = load_model(LogisticRegressionModel, str(tmp_path / "lr"))
    assert list(m2.coefficients) == list(m.coefficients)
    with pytest.raises(Exception):
        save_model(m, str(tmp_path / "lr"))
    save_model(m, str(tmp_path / "lr"), overwrite=True)
    ids = spark.range(100)
    assert [r.id for r in first_rows(ids, 3, "id").collect()] == [0, 1, 2]
