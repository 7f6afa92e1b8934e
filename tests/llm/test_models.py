"""Language profiles, toxicity, and the vector graph."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tests.llm import fixtures as X
from verdant.llm import hyperlang, toxicity, vectorgraph
from verdant.sources.tables import table


def held(doc_id, parts, part):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % parts == part


# Language

def test_language_of_awkward_rows(spark):
    rows = X.corpus()
    out = hyperlang.identify(X.frame(spark, rows)).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        assert r.held_out == held(r.doc_id, 5, 0) and 0 <= r.score <= 1
        by[r.doc_id] = r
    for doc_id, text, lang, _, _ in rows:
        if not any(c.isalpha() for c in text or ""):
            assert by[doc_id].lang_pred == "und" and by[doc_id].score == 0 or doc_id is None
    prose = [r for r in rows if r[0] is not None and r[0] < 60]
    assert sum(by[r[0]].lang_pred == r[2] for r in prose) == len(prose)


def test_language_held_out_accuracy(spark):
    docs = table(spark, SF_MID, "documents")
    out = hyperlang.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in out) >= 0.97 * len(out)


def test_language_without_labels(spark):
    rows = [(1, "some words", None, None, 0), (2, None, "en", None, 0)]
    assert {r.lang_pred for r in hyperlang.identify(X.frame(spark, rows)).collect()} == {"und"}
    assert hyperlang.identify(X.frame(spark, [])).collect() == []


def test_gram_vectors_are_bound_and_bundled():
    text = "Aba, 12 bac"
    grams = hyperlang.grams_of(text)
    codes = [0, *map(ord, "aba"), 0, *map(ord, "bac"), 0]
    expected = sum(np.roll(hyperlang.letter_vector(a), 2) * np.roll(hyperlang.letter_vector(b), 1) * hyperlang.letter_vector(c).astype(float)
                   for a, b, c in zip(codes, codes[1:], codes[2:]))
    assert len(grams) == len(codes) - 2
    assert np.array_equal(hyperlang.bundles([(0, grams[:3]), (0, grams[3:])], 1)[0], expected)


def test_long_text_in_slices(monkeypatch):
    rng = random.Random(1)
    texts = [X.prose(rng, 400), None, X.prose(rng, 20), "", X.prose(rng, 900)]
    whole = [hyperlang.bundles([(0, hyperlang.grams_of(t))], 1)[0] if t else None for t in texts]
    monkeypatch.setattr(hyperlang, "GROUP_CHARS", 100)
    sums = {}
    for group in hyperlang._groups(texts):
        for k, g in group:
            sums[k] = sums.get(k, 0) + hyperlang.bundles([(0, g)], 1)[0]
    assert set(sums) == {0, 2, 4} and all(np.array_equal(sums[k], whole[k]) for k in sums)


# Toxicity

def toxic_rows(n=900):
    rng, rows, labels = random.Random(7), [], []
    for i in range(n):
        words = X.prose(rng, rng.randrange(20, 120)).split(" ")
        bad = i % 6 == 0
        if bad:
            for _ in range(max(3, len(words) // 12)):
                words[rng.randrange(len(words))] = rng.choice(["vile", "rotten", "scoundrel", "filthy", "wretch", "swinehound"])
        rows.append((i, " ".join(words), "en", "s", 0))
        if i % 5 < 3:
            labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_scores(spark):
    rows, labels = toxic_rows()
    rows += [(5000, None, None, None, 0), (5001, "", None, None, 0), (None, "filthy wretch", None, None, 0), rows[3], (5002, "!" * 9000, None, None, 0)]
    frame = spark.createDataFrame([*labels, (None, 1), (7, None), (3, 0), (3, 0)], "doc_id long, toxic int")
    out = toxicity.score_toxicity(X.frame(spark, rows), frame).collect()
    assert len(out) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == held(r.doc_id, 4, 2) for r in out)
    right = [r.predicted == int(r.doc_id % 6 == 0) for r in out if r.doc_id is not None and r.doc_id < 5000 and r.held_out]
    assert sum(right) >= 0.97 * len(right)


def test_toxicity_never_reads_held_out_labels(spark):
    rows, labels = toxic_rows(300)
    other = [(i, 1 - y if held(i, 4, 2) else y) for i, y in labels]
    run = [{r.doc_id: r.score for r in toxicity.score_toxicity(
        X.frame(spark, rows), spark.createDataFrame(x, "doc_id long, toxic int")).collect()} for x in (labels, other)]
    assert run[0] == run[1]


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.score_toxicity(X.frame(spark, toxic_rows(20)[0]), none).collect()
    assert {(r.score, r.predicted) for r in out} == {(0.0, 0)}
    assert toxicity.score_toxicity(X.frame(spark, []), none).collect() == []


def test_label_model_discounts_correlated_voters():
    """Four copies of one weak voter must not outvote two good ones."""
    rng = np.random.default_rng(3)
    n = 20_000
    y = rng.random(n) < 0.3
    vote = lambda a: np.where(rng.random(n) < a, y, ~y).astype(int)
    weak = vote(0.65)
    copies = [np.where(rng.random(n) < 0.97, weak, 1 - weak) for _ in range(4)]
    votes = np.stack([vote(0.92), vote(0.9), *copies, vote(0.85)], axis=1)
    patterns, at = np.unique(np.column_stack([votes, np.where(rng.random(n) < 0.1, y, -1)]), axis=0, return_inverse=True)
    model = toxicity.LabelModel(patterns[:, :-1], np.bincount(at.ravel()).astype(float), patterns[:, -1])
    right = (model.posterior(votes) >= 0.5) == y
    majority = (votes.sum(axis=1) > 3.5) == y
    assert right.mean() > 0.95 > majority.mean() + 0.05
    assert sum(p in range(2, 6) for p in model.parent[2:6]) >= 3


# Vectors

def vector_rows(seed=1, n=500, dim=16):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=dim).tolist(), int(rng.integers(3))) for i in range(n)]
    for k in range(60):                                     # a loose group, links between many of its vectors
        rows.append((n + k, (np.array(rows[0][1]) + rng.normal(size=dim) * 0.24).tolist(), rows[0][2]))
    rows += [(n + 100 + k, rows[5][1], rows[5][2]) for k in range(9)]             # copies
    rows += [(n + 150, rows[5][1], 99), (n + 151, (np.array(rows[6][1]) * 1e-30).tolist(), rows[6][2]), rows[7],
             (n + 152, rows[8][1], None), (n + 153, None, 1), (n + 154, [], 1), (n + 155, [0.0] * dim, 1), (n + 156, [0.0] * dim, 1),
             (n + 157, [math.nan] * dim, 1), (n + 158, [math.inf] * dim, 1), (n + 159, rows[9][1][:-1] + [None], rows[9][2]),
             (n + 160, rows[9][1][:4], rows[9][2]), (None, rows[9][1], rows[9][2]), (n + 161, [1e30] * dim, 1), (n + 162, [1e30] * dim, 1)]
    return rows


def vector_brute(rows, threshold=0.93):
    seen = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=np.float32).astype(float)
            x /= np.abs(x).max()
            seen[i] = (x / np.linalg.norm(x), label)
    ids = sorted(seen)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if seen[a][1] == seen[b][1] and len(seen[a][0]) == len(seen[b][0])
             and seen[a][0] @ seen[b][0] >= threshold]
    count = {i: 0 for i, _, _ in rows}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    found = X.components({i for i, _, _ in rows if i is not None}, links)
    return {i: (count[i], found.get(i)) for i, _, _ in rows}


def vector_frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(X.CLASHES) if c != "label"])


@pytest.mark.parametrize("target, cap", [(1500, 3000), (40, 25), (40, 1000)])
def test_vectors_equal_brute_force(spark, monkeypatch, target, cap):
    monkeypatch.setattr(vectorgraph, "TARGET", target)
    monkeypatch.setattr(vectorgraph, "CAP", cap)
    rows = vector_rows()
    expected = vector_brute(rows)
    out = vectorgraph.near_duplicate_vectors(vector_frame(spark, rows)).collect()
    assert len(out) == len(rows)
    links = sum(n for n, _ in expected.values())
    missed = sum(abs(r.n_links - expected[r.vec_id][0]) for r in out if r.vec_id is not None)
    assert missed <= (0 if target == 1500 else 0.05 * links)
    if not missed:
        assert all((r.n_links, r.component_id) == expected[r.vec_id] for r in out)
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in out)


def test_vectors_empty(spark):
    assert vectorgraph.near_duplicate_vectors(vector_frame(spark, [])).collect() == []


def test_graph_reaches_everything_and_search_finds_links():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(400, 24)), rng.normal(size=(1, 24)) + 0.05 * rng.normal(size=(200, 24))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lists = vectorgraph.build_graph(x)
    seen, todo = set(), [vectorgraph.medoid_of(x)]
    while todo:
        i = todo.pop()
        if i not in seen:
            seen.add(i)
            todo.extend(lists[i])
    assert len(seen) == len(x)
    graph = np.full((len(x), max(map(len, lists))), -1)
    for i, near in enumerate(lists):
        graph[i, :len(near)] = near
    q, m = vectorgraph.range_search(x, x, graph, 0.93)
    truth = set(zip(*np.nonzero(x @ x.T >= 0.93)))
    assert set(zip(q.tolist(), m.tolist())) <= {(int(a), int(b)) for a, b in truth}
    assert len(set(zip(q.tolist(), m.tolist()))) >= 0.99 * len(truth)


def test_audit_counts_true_links(spark):
    rows = vector_rows()
    nodes = spark.createDataFrame([(i, label, len(v), 1, v) for i, v, label in rows[:560]], "rep long, label long, dim int, copies long, vector array<float>")
    truth = vector_brute(rows[:560])
    found = spark.createDataFrame([(i, n) for i, (n, _) in truth.items()], "rep long, links long")
    assert vectorgraph.audit_recall(nodes, found, 0.93) == 1.0
    assert vectorgraph.audit_recall(nodes, found.withColumn("links", F.lit(0)), 0.93) < 0.2


def rare_links(spark, n=2000, dim=32):
    """One label of random vectors, of which a few have a loose near copy; these are the last that an audit draws."""
    ids = [r.id for r in spark.range(n + 8).orderBy(F.xxhash64("id"), "id").collect()]
    rng = np.random.default_rng(12)
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turned = rng.normal(size=(8, dim))
    turned -= (turned * x[-8:]).sum(axis=1, keepdims=True) * x[-8:]
    turned /= np.linalg.norm(turned, axis=1, keepdims=True)
    return [(i, v.tolist(), 0) for i, v in zip(ids, np.concatenate([x, 0.935 * x[-8:] + math.sqrt(1 - 0.935**2) * turned]))]


@pytest.mark.parametrize("most", [16_384, 256])
def test_rare_links_are_all_found(spark, monkeypatch, most):
    """The first audit draw may have no link; that measures nothing."""
    monkeypatch.setattr(vectorgraph, "TARGET", 20)
    monkeypatch.setattr(vectorgraph, "CAP", 300)
    monkeypatch.setattr(vectorgraph, "OVERLAPS", (1, 2))
    monkeypatch.setattr(vectorgraph, "AUDIT_MOST", most, raising=False)
    rows = rare_links(spark)
    expected = vector_brute(rows)
    assert sum(n for n, _ in expected.values()) == 16
    out = vectorgraph.near_duplicate_vectors(vector_frame(spark, rows)).collect()
    assert all((r.n_links, r.component_id) == expected[r.vec_id] for r in out)


def test_rare_pairs_go_through_the_graph(spark, monkeypatch):
    """200 near pairs among 20,000 vectors of one label: found by the search, not by comparing all."""
    calls = []
    monkeypatch.setattr(vectorgraph, "all_links", lambda nodes, t, f=vectorgraph.all_links: calls.append(nodes.count()) or f(nodes, t))
    rng = np.random.default_rng(21)
    x = rng.normal(size=(20_000, 64))
    near = x[:200] / np.linalg.norm(x[:200], axis=1, keepdims=True) + 0.03 * rng.normal(size=(200, 64))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([x, near]))]
    out = {r.vec_id: (r.n_links, r.component_id) for r in vectorgraph.near_duplicate_vectors(vector_frame(spark, rows)).collect()}
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    pairs = [k for k in range(200) if (unit(x[:200])[k] @ unit(near)[k]) >= 0.93]
    assert len(pairs) > 150 and set(calls) == {0}
    assert sum(out[k] == (1, k) and out[20_000 + k] == (1, k) for k in pairs) >= 0.99 * len(pairs)
    assert sum(n for n, _ in out.values()) <= 2 * len(pairs)


def test_bounded_centres_still_give_bounded_clusters(spark, monkeypatch):
    """Two centres for a label of 4,000 vectors: its clusters are cut again until they are small, but for a ball of near
    copies of one vector, which no cut could part without losing its links."""
    for name, value in (("TARGET", 50), ("CAP", 120), ("MAX_CENTRES", 2), ("SPLIT_SAMPLE", 300), ("FANOUT", 8)):
        monkeypatch.setattr(vectorgraph, name, value)
    cuts, compared = [], []

    def cut(placed, overlap, threshold, f=vectorgraph.cut_large):
        out = f(placed, overlap, threshold)
        each = out.select("rep", F.explode("places.cluster").alias("cluster"))
        cuts.append((overlap, out.count(), each.groupBy("rep").count().agg(F.max("count")).first()[0],
                     [(r["n"], r["ball"], r["level"]) for r in each.groupBy("cluster").agg(
                         F.count("*").alias("n"), F.sum((F.col("rep") >= 4000).cast("int")).alias("ball"),
                         F.first(F.col("cluster").bitwiseAND(15)).alias("level")).collect()]))
        return out

    monkeypatch.setattr(vectorgraph, "cut_large", cut)
    monkeypatch.setattr(vectorgraph, "all_links", lambda nodes, t, f=vectorgraph.all_links: compared.append(nodes.count()) or f(nodes, t))
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 24))
    x[3900:] = x[:100] + 0.1 * rng.normal(size=(100, 24))
    ball = rng.normal(size=24) + 0.1 * rng.normal(size=(600, 24))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([x, ball]))]
    expected = vector_brute(rows)
    out = vectorgraph.near_duplicate_vectors(vector_frame(spark, rows)).collect()
    overlap, n, places, sizes = cuts[0]
    assert (n, places) == (len(rows), overlap) and max(level for _, _, level in sizes) >= 2
    assert all(size - near <= vectorgraph.split_size(overlap) for size, near, _ in sizes)
    assert max(near for _, near, _ in sizes) == 600                              # whole in a cluster
    assert set(compared) == {0}
    links = sum(n for n, _ in expected.values())
    assert sum(abs(r.n_links - expected[r.vec_id][0]) for r in out) <= 0.01 * links
    pairs = [r for r in out if r.vec_id < 100 or 3900 <= r.vec_id < 4000]
    assert sum((r.n_links, r.component_id) == expected[r.vec_id] for r in pairs) >= 0.95 * len(pairs)


def test_cells_of_a_ball_stay_together():
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(200, 16)), 3 * rng.normal(size=16) + 0.1 * rng.normal(size=(200, 16))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    part = vectorgraph.joined_cells(x, x[[0, 1, 2, 200, 250, 399]], 0.93)
    assert len(set(part[:3])) == 3 and len(set(part[3:])) == 1 and part[3] not in part[:3]


def test_numbers_of_clusters_differ():
    codes = [vectorgraph.child_code(c) for c in range(100)]
    for parent in codes[:100]:
        codes += [vectorgraph.child_code(c, parent) for c in range(vectorgraph.FANOUT)]
    codes += [vectorgraph.child_code(c, parent) for parent in codes[100:300] for c in range(vectorgraph.FANOUT)]
    assert len(set(codes)) == len(codes)
    code = vectorgraph.child_code(vectorgraph.MAX_CENTRES - 1)
    for _ in range(vectorgraph.LEVELS):
        code = vectorgraph.child_code(vectorgraph.FANOUT - 1, code)
    assert code < 2**63 and code & 15 == vectorgraph.LEVELS


def test_doubles_stay_doubles(spark):
    """Components beyond the range of floats are finite, and a cosine is not rounded to floats first."""
    rows = [(1, [1e200, 2e200], 0), (2, [1.0, 2.0], 0), (3, [1.0, float("inf")], 0), (4, [2e-300, 4e-300], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert {(r.vec_id, r.n_links, r.component_id) for r in vectorgraph.near_duplicate_vectors(df).collect()} == {(1, 2, 1), (2, 2, 1), (3, 0, 3), (4, 2, 1)}


@pytest.mark.parametrize("target", [1500, 40])
def test_search_that_misses_links_is_not_returned(spark, monkeypatch, target):
    """Also where no label has several clusters."""
    monkeypatch.setattr(vectorgraph, "TARGET", target)
    monkeypatch.setattr(vectorgraph, "CAP", 100)
    monkeypatch.setattr(vectorgraph, "range_search", lambda *args, **options: (np.zeros(0, int), np.zeros(0, int)))
    rows = vector_rows()
    expected = vector_brute(rows)
    out = vectorgraph.near_duplicate_vectors(vector_frame(spark, rows)).collect()
    assert all((r.n_links, r.component_id) == expected[r.vec_id] for r in out)
