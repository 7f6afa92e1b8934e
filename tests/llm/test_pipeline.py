"""The pipeline, stage by stage, against plain-Python versions on a small table."""

from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from tests.llm import fixtures as X
from tests.llm.test_documents import line_brute
from verdant.llm import mixing, packing


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's input and output as rows."""
    rows = [r for r in X.corpus(seed=4, n=80) if r[0] is not None and (r[1] is None or "\0" not in r[1])]
    rows = list(dict.fromkeys(rows))
    docs, out = X.frame(spark, rows, clashes=False), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, None).write.parquet(path)
        after = spark.read.parquet(path)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns, name
        out.append(([tuple(r) for r in docs.collect()], [tuple(r) for r in after.collect()]))
        docs = after
    return out


def test_quality_stage(stages):
    before, after = stages[0]
    good = {r[0] for r in before if not (X.base_counts(r[1])[0] < 10 or 100 * X.base_counts(r[1])[4] > 20 * X.base_counts(r[1])[0])}
    assert {r[0] for r in after} <= good
    assert {r[0] for r in before if r[0] < 80} <= {r[0] for r in after}       # prose stays


def test_line_stage(stages):
    before, after = stages[1]
    first, rest = line_brute(before, 20)
    expected = {}
    for r in before:
        lines = rest[r[1]]
        if not (r[0] > first[r[1]] and len(X.words(r[1])) >= 20) and lines:
            expected[r[0]] = [x.strip() for x in lines]
    got = {r[0]: [x.strip() for x in r[1].split("\n") if X.words(x)] for r in after}
    assert got == expected
    assert all(r[4] == len(r[1]) for r in after)


def test_near_stage(stages):
    before, after = stages[2]
    groups = X.near_duplicates(before, 5)
    assert sorted(after) == sorted(r for r in before if groups[r[0]][1] == r[0])


def in_duck(rows, sql):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    return con.execute(sql).fetchall()


def test_mixing_stage(stages):
    before, after = stages[3]
    copies = {r[0]: r[5] for r in in_duck(before, "SELECT doc_id, source, size, source_size, target, copies FROM ("
                                          + mixing.ORACLE.format(documents="documents") + ")")}
    assert Counter(r[0] for r in after) == Counter({k: v for k, v in copies.items() if v})


def test_packing_stage(stages):
    before, after = stages[4]
    assert Counter(after) == Counter(in_duck(before, packing.oracle()))


def test_run(spark):
    from tests.conftest import SF_SMALL
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "mixing", "packing"]
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert out and all(r.length <= r.padded for r in out)
