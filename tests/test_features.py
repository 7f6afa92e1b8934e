"""Page-table reading, cleaning, dictionary, one-hot, scaling, splits."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from verdant.operators.features import (category_dictionary, features_array, fit_features,
                                        parse_pages)
from verdant.operators.split import hash_split, split_label
from verdant.sources.flags import flag_lines, parse_flags, synthetic_flags
from verdant.sources.pages import read_page_tsv

HEADER = '"url"\t"urlid"\t"text"\t"category"\t"x1"\t"x2"\t"label"\n'


def _tsv(tmp_path, name, rows):
    p = tmp_path / name
    p.write_text(HEADER + "".join("\t".join(r) + "\n" for r in rows))
    return str(p)


ROWS_A = [['"http://a.example/1"', '"1"', '"t"', '"news"', '"0.5"', '"?"', '"1"'],
          ['"http://a.example/2"', '"2"', '"t"', '"?"', '"1.5"', '"3"', '"0"']]
ROWS_B = [['"http://a.example/3"', '"3"', '"t"', '"news"', '"2.5"', '"3"', '"1.0"'],
          ['"http://a.example/4"', '"4"', '"t"', '"sport"', '"3.5"', '"3"', '"0"']]


def test_tsv_two_files_each_header_dropped(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    _tsv(d, "a.tsv", ROWS_A)
    _tsv(d, "b.tsv", ROWS_B)
    raw = read_page_tsv(spark, str(d))
    assert raw.count() == 4
    parsed = parse_pages(raw, has_label=True)
    got = {r.url: (r.category, r.x1, r.x2, r.label) for r in parsed.collect()}
    assert got["http://a.example/1"] == ('"news"', 0.5, 0.0, 1.0)    # "?" -> 0.0
    assert got["http://a.example/2"] == ('"?"', 1.5, 3.0, 0.0)       # "?" category is a category
    assert got["http://a.example/3"][3] == 1.0                      # label 1.0 accepted


def test_non_number_fails_and_modes(spark, tmp_path):
    bad = [['"u"', '"1"', '"t"', '"news"', '"abc"', '"1"', '"1"']]
    raw = read_page_tsv(spark, _tsv(tmp_path, "bad.tsv", bad))
    with pytest.raises(Exception):
        parse_pages(raw, has_label=True).collect()
    assert parse_pages(raw, True, on_bad="zero").first().x1 == 0.0
    assert parse_pages(raw, True, on_bad="null").count() == 0


def test_label_must_be_binary(spark, tmp_path):
    raw = read_page_tsv(spark, _tsv(tmp_path, "l.tsv", [['"u"', '"1"', '"t"', '"n"', '"1"', '"1"', '"2"']]))
    with pytest.raises(Exception):
        parse_pages(raw, has_label=True).collect()


def test_dictionary_alphabetical_and_onehot_full(spark, tmp_path):
    raw = read_page_tsv(spark, _tsv(tmp_path, "a.tsv", ROWS_A + ROWS_B))
    parsed = parse_pages(raw, True)
    d = {r.category: r.category_index for r in category_dictionary(parsed).collect()}
    assert d == {'"?"': 0, '"news"': 1, '"sport"': 2}
    fm = fit_features(parsed, ["x1", "x2"], scale=False)
    feats = {r.url: r.f for r in fm.transform(parsed).select("url", features_array().alias("f")).collect()}
    assert feats["http://a.example/4"] == [0.0, 0.0, 1.0, 3.5, 3.0]   # one slot per category, none dropped


def test_unseen_category_fails_by_default(spark, tmp_path):
    raw = read_page_tsv(spark, _tsv(tmp_path, "a.tsv", ROWS_A))
    fm = fit_features(parse_pages(raw, True), ["x1", "x2"], scale=False)
    other = parse_pages(read_page_tsv(spark, _tsv(tmp_path, "b.tsv", ROWS_B)), True)
    with pytest.raises(Exception):
        fm.transform(other).select(vector_to_array("features")).collect()


def test_scaler_sample_std_and_constant_column(spark, tmp_path):
    raw = read_page_tsv(spark, _tsv(tmp_path, "a.tsv", ROWS_A + ROWS_B))
    parsed = parse_pages(raw, True)
    fm = fit_features(parsed, ["x1", "x2"], scale=True)
    rows = fm.transform(parsed).select("url", features_array().alias("f")).orderBy("url").collect()
    x1 = [r.f[3] for r in rows]
    import statistics
    raw_x1 = [0.5, 1.5, 2.5, 3.5]
    mu, sd = statistics.mean(raw_x1), statistics.stdev(raw_x1)
    assert x1 == pytest.approx([(v - mu) / sd for v in raw_x1])
    # x2 = [0, 3, 3, 3] is not constant; build a constant one
    const = parsed.withColumn("x2", F.lit(7.0))
    fm2 = fit_features(const, ["x1", "x2"], scale=True)
    assert {r.f[4] for r in fm2.transform(const).select(features_array().alias("f")).collect()} == {0.0}


def test_dictionary_from_all_rows_scaler_from_train(spark, tmp_path):
    from verdant.plans.jobs import prepare_pages
    rows = [[f'"http://a.example/{i}"', f'"{i}"', '"t"', '"news"' if i % 50 else '"rare"',
             f'"{i}"', '"1"', f'"{i % 2}"'] for i in range(200)]
    raw = read_page_tsv(spark, _tsv(tmp_path, "many.tsv", rows))
    parts, fm, _ = prepare_pages(raw, scale=True)
    # every category is in the dictionary, whatever part its rows fell into
    assert [r.category for r in fm.dictionary.orderBy("category_index").collect()] == ['"news"', '"rare"']
    for name in ("train", "validation", "test"):
        parts[name].select(features_array().alias("f")).collect()
    scaler = fm.scaler
    train_x = [r.x1 for r in parts["_rows"].where("_split = 'train'").collect()]
    assert scaler.mean[2] == pytest.approx(sum(train_x) / len(train_x))


def test_hash_split_stable_and_proportional(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    parts = hash_split(df, "k")
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 20000
    assert abs(sizes[0] / 20000 - 0.8) < 0.02 and abs(sizes[1] / 20000 - 0.1) < 0.02
    a = {r.k for r in parts[1].collect()}
    b = {r.k for r in hash_split(df.repartition(7), "k")[1].collect()}
    assert a == b   # independent of partitioning
    one = df.select(split_label(F.col("k")).alias("s")).distinct().collect()
    assert {r.s for r in one} == {"train", "validation", "test"}


def test_flag_lines_parse(spark):
    lines = spark.createDataFrame([("23100000,1,0,1,0,0,1,1",), ("23100001,0,0,1,1,0,1,0",)], "value string")
    r = parse_flags(lines).orderBy("barcode").collect()
    assert r[0].barcode == "23100000" and r[0].label == 1.0 and [r[0][f"m{i}"] for i in range(1, 7)] == [1, 0, 1, 0, 0, 1]
    g = parse_flags(synthetic_flags(spark, 50, seed=3))
    assert g.count() == 50 and g.where("label NOT IN (0, 1)").count() == 0
    assert flag_lines(spark, "/root/testdata/sf0.001").count() == 87


@pytest.mark.parametrize("name", ["clean_numeric", "category_onehot", "page_features", "standard_scale",
                                  "hash_split", "parse_flag_csv", "score_rows", "page_tsv", "random_split", "category_index"])
def test_feature_queries_match_duckdb_small(spark, duck, name):
    from tests.helpers import assert_same
    import __spark_entry__ as E
    assert_same(E.queries()[name](spark, "/root/testdata/sf0.001"), duck.execute(E.oracle_sql()[name]))


def test_large_labels_path_equals_broadcast_path(spark):
    """Forcing the 'labels too big to broadcast' plan gives the same rows."""
    from verdant.sources.pages import labelled_page_rows
    sf = "/root/testdata/sf0.001"
    a = labelled_page_rows(spark, sf)
    b = labelled_page_rows(spark, sf, max_broadcast_bytes=10)
    assert a.columns == b.columns
    assert sorted(a.collect()) == sorted(b.collect())
    assert sorted(flag_lines(spark, sf).collect()) == sorted(flag_lines(spark, sf, max_broadcast_bytes=10).collect())
